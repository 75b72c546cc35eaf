"""Approximate nearest neighbours by collision counting over single projections.

Largest inner products become nearest neighbours by one more component: vectors are lifted to one length, queries get a
zero there. Every vector of a shard is projected on ``projections`` random lines, and each line keeps its values in order.
A query opens a window around its own value on every line; virtual rehashing widens all windows by a factor until enough
vectors are in at least ``collisions`` of the windows. Those are verified by the exact inner product. The search stops at
``verified`` of the shard's vectors and the wanted number, or if it has seen all.

Queries are dealt into blocks and vectors into shards; each block meets each shard in a task of its own, and the best of
each shard are merged by rank. Null, zero or non-finite vectors take no part; those of another length meet only their
like. Ties go to the smaller id; rows that share an id are vectors of their own. Fewer candidates than wanted: all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved
from .vectors import matrix, usable

PROJECTIONS, COLLISIONS, VERIFIED, WIDEN, FIRST = 80, 0.62, 0.2, 1.15, 0.9
SHARD_ROWS, BLOCK_ROWS = 20_000, 512
#: Ranks that are compared at a time: those of all lines stay in a core's cache.
CHUNK = 2048


class Lines:
    """Projections of the vectors of a shard, sorted on each line, and the rank of each vector there."""

    def __init__(self, v: np.ndarray, longest: float, projections: int = PROJECTIONS, seed: int = 11):
        self.v = v
        lift = np.sqrt(np.maximum(longest**2 - np.einsum("nd,nd->n", v, v), 0))
        self.axes = np.random.default_rng(seed).standard_normal((v.shape[1] + 1, projections))
        value = (np.hstack([v, lift[:, None]]) @ self.axes).T.copy()
        order = np.argsort(value, axis=1, kind="stable")
        self.sorted = np.take_along_axis(value, order, axis=1)
        self.rank = np.empty(order.shape, np.uint16 if len(v) < 2**16 else np.uint32)
        np.put_along_axis(self.rank, order, np.arange(len(v), dtype=self.rank.dtype)[None, :], axis=1)
        self.longest = longest

    def collisions(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """On how many lines each vector's rank is in the window [a, b) of that line."""
        lines, n = self.rank.shape
        kind = self.rank.dtype
        first, width = a.astype(kind)[:, None], (b - a).astype(kind)[:, None]
        out = np.empty(n, np.uint8 if lines < 2**8 else np.uint32)
        past, held = np.empty((lines, min(n, CHUNK)), kind), np.empty((lines, min(n, CHUNK)), bool)
        for lo in range(0, n, CHUNK):
            some = self.rank[:, lo : lo + CHUNK]
            m = some.shape[1]
            # ranks before the window wrap around and are beyond its width
            np.less(np.subtract(some, first, out=past[:, :m]), width, out=held[:, :m])
            np.add.reduce(held.view(np.uint8)[:, :m], axis=0, dtype=out.dtype, out=out[lo : lo + m])
        return out

    def candidates(self, q: np.ndarray, wanted: int, collisions: float, verified: float):
        """For each query the vectors that collide with it on enough lines."""
        lines, n = self.rank.shape
        need = int(np.ceil(collisions * lines))
        enough = min(n, wanted + int(np.ceil(verified * n)))
        # a query's length sets no order among its neighbours, so all have that of the longest vector
        scale = self.longest / np.maximum(np.linalg.norm(q, axis=1), 1e-300)
        value = np.hstack([q * scale[:, None], np.zeros((len(q), 1))]) @ self.axes
        half, todo = FIRST * self.longest, np.arange(len(q))
        while len(todo):
            a, b = np.empty((len(todo), lines), np.int64), np.empty((len(todo), lines), np.int64)
            for j, s in enumerate(self.sorted):
                a[:, j] = np.searchsorted(s, value[todo, j] - half)
                b[:, j] = np.searchsorted(s, value[todo, j] + half, side="right")
            left = []
            for i, x, y in zip(todo.tolist(), a, b, strict=True):
                close = np.flatnonzero(self.collisions(x, y) >= need)
                if len(close) >= enough or (x == 0).all() and (y == n).all():
                    yield i, close
                else:
                    left.append(i)
            todo, half = np.array(left, np.int64), half * WIDEN


def nearest(v: np.ndarray, ids: np.ndarray, q: np.ndarray, q_ids: np.ndarray, longest: float, k: int, collisions: float = COLLISIONS, verified: float = VERIFIED):
    """(query, id, score) of the best ``k`` verified candidates of each query, its own id left out."""
    out = []
    for i, close in Lines(v, longest).candidates(q, k + 1, collisions, verified):
        close = close[ids[close] != q_ids[i]]
        score = np.einsum("nd,d->n", v[close], q[i])
        if len(close) > k:  # the best by score, with all that tie with the last of them
            best = score >= np.partition(score, len(score) - k)[len(score) - k]
            close, score = close[best], score[best]
        top = np.lexsort((ids[close], -score))[:k]
        out += [(int(q_ids[i]), int(ids[close[t]]), float(score[t])) for t in top]
    return out


def search(table: DataFrame, queries: DataFrame, k: int = 20, collisions: float = COLLISIONS, verified: float = VERIFIED, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for each of ``queries`` among the other rows of ``table``."""
    rows, asked = saved(usable(table), "vectors"), usable(queries)
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    n, longest = rows.agg(F.count("*"), F.max(norm)).first()
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-asked.count() // BLOCK_ROWS))
    longest = float(longest or 1.0) * (1 + 1e-12)

    def ask(block, shard):
        found = []
        if block.num_rows and shard.num_rows:
            block, shard = block.sort_by("query_id"), shard.sort_by("vec_id")
            found = nearest(matrix(shard.column("v")), shard.column("vec_id").to_numpy(), matrix(block.column("q")), block.column("query_id").to_numpy(), longest, k, collisions, verified)
        cols = list(zip(*found, strict=True)) or [(), (), ()]
        return pa.table({c: pa.array(x, t) for c, x, t in zip(("query_id", "vec_id", "score"), cols, (pa.int64(), pa.int64(), pa.float64()), strict=True)})

    both = F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")), F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))
    asked = asked.select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"), "d", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("block"), F.explode(both[0]).alias("shard"))
    rows = rows.select("vec_id", "v", "d", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(shards)).alias("shard"), F.explode(both[1]).alias("block"))
    key = ["block", "shard", "d"]
    found = asked.groupBy(*key).cogroup(rows.groupBy(*key)).applyInArrow(ask, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
