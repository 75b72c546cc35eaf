"""Vectors of a table that take part in a search, and blocks of them as single rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(table: DataFrame, zero: bool = False) -> DataFrame:
    """(vec_id, v): vectors with an id, at least one component, and only finite ones; the zero vector if ``zero``.

    Vectors of another length than most are compared with those of their length only, so the length goes along as ``d``.
    """
    v = F.transform(F.col("embedding"), lambda x: x.cast("double"))
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where("vec_id is not null and size(v) > 0")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(finite)
    if not zero:
        rows = rows.where(F.exists("v", lambda x: x != 0))
    return rows.select("vec_id", "v", F.size("v").alias("d"))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A column of equally long lists as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), float).reshape(n, -1)


def finite(table: DataFrame) -> DataFrame:
    """(vec_id, label, v, d): every row whose vector is there and holds finite numbers only, of length ``d``.

    Ids and labels may be null or repeated, a table without labels has null ones, and a vector may be zero or empty.
    """
    label = F.col("label") if "label" in table.columns else F.lit(None).cast("int").alias("label")
    v = F.transform(F.col("embedding"), lambda x: x.cast("double")).alias("v")
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), label, v).where("v is not null")
    rows = rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    return rows.withColumn("d", F.size("v"))


def scaled(column: str, largest: int):
    """``floor(1024 * x)`` of every component as a whole number, none beyond ``largest`` on either side."""
    return F.transform(column, lambda x: F.floor(F.least(F.greatest(x * 1024.0, F.lit(float(-largest))), F.lit(float(largest)))))


def lengths(rows: DataFrame) -> list[int]:
    """The lengths of vectors in a table: as many as there were models that made them."""
    return sorted(r.d for r in rows.select("d").distinct().collect())


def exact_sums(x: np.ndarray, weight: np.ndarray | None = None) -> list[int]:
    """Sums by column of whole numbers, as integers of any size."""
    if not len(x):
        return [0] * x.shape[1]
    heaviest = 1 if weight is None else int(weight.max())
    if max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) * heaviest * len(x) < 2**62:
        return [int(s) for s in (x.sum(axis=0) if weight is None else weight @ x)]
    x = x.astype(object)
    return [int(s) for s in (x.sum(axis=0) if weight is None else weight.astype(object) @ x)]
