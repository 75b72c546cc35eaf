"""Latest version per key, first delivery per key, and repeats of a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str | Column], order: list[Column]) -> DataFrame:
    """One row per key, the first in the given order.

    Spark limits each key to one row before the shuffle (``WindowGroupLimit``), so a hot key
    sends one row per input partition and never lands whole in one task.
    """
    ranked = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", ranked).where(F.col("_rank") == 1).drop("_rank")


def keep_latest(df: DataFrame, keys: list[str | Column], order_cols: list[str | Column]) -> DataFrame:
    """One row per key, the largest in the order columns; NULL sorts above every value."""
    return keep_first(df, keys, [_col(c).desc_nulls_first() for c in order_cols])


def repeats(df: DataFrame, keys: list[str], row_id: list[str], carry: tuple[str, ...] = ()) -> DataFrame:
    """The keys, row ids and carried columns of the second and later rows of each key.

    ``row_id`` is what tells rows apart, such as file and record number. Only keys with more than one row leave the
    partial aggregate, and rows are joined to those, so most are not shuffled whole and a hot key can be split.
    """
    narrow = df.select(*keys, *row_id, *carry)
    several = narrow.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct(*row_id)).alias("_first"))
    again = narrow.join(several.where("_n > 1").drop("_n"), keys)
    return again.where(F.struct(*row_id) != F.col("_first")).select(*keys, *row_id, *carry)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
