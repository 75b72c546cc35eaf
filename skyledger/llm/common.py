"""Helpers that the operators of this package share: input columns, written tables, hashing of words and bytes."""

from __future__ import annotations

import itertools
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_folder

MAX_LONG = 2**63 - 1
U64 = np.uint64
_MULTIPLIER = 0x9E3779B97F4A7C15 | 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(docs: DataFrame) -> DataFrame:
    """``doc_id`` as long and ``text`` with null read as empty; every other column is left behind."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def keyed(docs: DataFrame) -> DataFrame:
    """``documents`` with a row key: ``doc_id`` (null: the largest long) and a hash of the text.

    Rows that share both are equal rows; what is found for one holds for each of them.
    """
    return documents(docs).select("doc_id", "text", F.coalesce("doc_id", F.lit(MAX_LONG)).alias("doc_key"), F.xxhash64("text").alias("text_key"))


def saved(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table below the shared folder and read it from there: lineage ends, and any executor can be lost."""
    path = f"{work_folder(df.sparkSession, purpose)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.saved_at = path
    return table


def forget(*tables: DataFrame) -> None:
    """Delete tables that ``saved`` wrote, once nothing that is still to be computed reads them."""
    for df in tables:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(df.saved_at)
        path.getFileSystem(conf).delete(path, True)


def release() -> None:
    """Give free memory back to the system: an idle worker would keep it from the other processes of its executor."""
    import ctypes

    import pyarrow as pa

    _powers.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def slices(batches, weight, most: int = 2_000_000):
    """Cut Arrow batches where ``weight(batch)`` (an array of sizes by row) adds up to ``most``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        part = np.cumsum(weight(batch)) // most
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for lo, hi in itertools.pairwise(cuts):
            if hi > lo:
                yield batch.slice(lo, hi - lo)
    release()


def text_sizes(batch, name: str = "text"):
    import pyarrow.compute as pc

    return np.asarray(pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False), np.int64) + 64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose bits all depend on each other."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int, multiplier: int):
    have = _powers.get(multiplier)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        up, down = np.full(size, multiplier, U64), np.full(size, pow(multiplier, -1, 2**64), U64)
        up[0] = down[0] = 1
        with np.errstate(over="ignore"):
            have = (np.multiply.accumulate(up), np.multiply.accumulate(down))
        _powers[multiplier] = have
    return have


class Rolling:
    """Hashes of any ranges of a sequence of integers, from one running sum modulo 2**64."""

    def __init__(self, values: np.ndarray, multiplier: int = _MULTIPLIER):
        up, self.down = _power_tables(len(values) + 1, multiplier)
        self.sums = np.zeros(len(values) + 1, U64)
        np.cumsum((values.astype(U64) + U64(1)) * up[: len(values)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])


SECOND = 0xD6E8FEB86659FD93


def words_of(texts: list[str]):
    """Words ``[^\\x20\\x09-\\x0D]+`` of many texts.

    Returns the words joined by one space each, where each one starts and ends in these bytes, and for each text the
    number of its first word.
    """
    return split_words([b" ".join(t.encode().split()) for t in texts])


def split_words(raw: list[bytes]):
    """The same for texts whose words are joined by one space already."""
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    blank = data == 32
    edge = np.flatnonzero(np.diff(np.concatenate(([True], blank)).view(np.int8)))
    start, end = edge[0::2], edge[1::2]
    begins = np.concatenate(([0], np.cumsum([len(r) + 1 for r in raw])))
    return data, start, end, np.searchsorted(start, begins)
