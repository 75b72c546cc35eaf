"""Whitening of vectors by a covariance over distinct vectors, weighted by how often each one occurs.

Components become integers, ``floor(1024 * c) + 100000``, and rows with the same integers are one distinct vector; an
aggregate that combines before it shuffles gives each its count, so a vector that a third of all rows repeat costs one
row for each task. Distinct vectors are written, and three passes read them: exact sums by component in whole numbers,
the covariance as products of centred, weighted blocks (``(x - S/n)' W (x - S/n)``, a ``d * d`` matrix for each task whose
rows are added up by their index), and the projection of each distinct vector, once, on the eigenvectors. Only sums, the
``d * d`` covariance and its eigenvectors come to the driver, whatever the input. Rows then meet the whitened vector by
128 bits of a hash of their integers. Vectors that more than one row in a hundred repeat are at most a hundred, so these
are broadcast, and no task of the join takes all rows of a hot one.

``weights="counts"`` fits on all rows, ``weights="one"`` on distinct vectors alone. Eigenvectors have the sign that makes
their largest component positive. Each length of vectors is whitened on its own. Null ids are kept, equal rows give equal
results, empty vectors have no components and no rows. A direction without variance has ``whitened`` and ``explained``
0, and ``identity_error`` says so. Components are bounded by 2**52, which no finer number than a whole one can pass.
``deviation`` is null where it is beyond the largest long; ``deviation_exact`` holds it as a decimal. An empty table
gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MAX_LONG, forget, release, saved
from .vectors import exact_sums, finite, lengths, matrix, scaled

COMPONENTS, SHIFT, LARGEST = 8, 100_000, 2**52
#: A vector with more copies than this share of the rows, and than so many, is broadcast when rows are joined to it.
HOT_SHARE, HOT_LEAST = 1 / 100, 10_000
BLOCK = 8_192
_RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_exact decimal(38,0)"


@dataclass
class Fit:
    """What the projection needs: the number of fitted rows, exact sums, and directions with what each explains."""

    n: int
    sums: list[int]
    directions: np.ndarray
    explained: list[float]

    def centre(self) -> np.ndarray:
        return np.array([float(Fraction(s, max(self.n, 1))) for s in self.sums])


def _blocks(batches):
    """(copies, matrix of whole numbers, rows) in blocks of bounded size."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            yield part.column("fit").to_numpy(), matrix(part.column("x")).astype(np.int64), part


def _sums(distinct: DataFrame) -> tuple[int, list[int]]:
    """The weight of all rows and the weighted sums by component, exactly."""

    def sums(batches):
        n, total = 0, None
        for weight, x, _ in _blocks(batches):
            new = exact_sums(x, weight)
            n, total = n + int(weight.sum()), new if total is None else [a + b for a, b in zip(total, new, strict=True)]
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([-1, *range(len(total))], pa.int32()), pa.array([str(n), *map(str, total)])], names=["i", "s"])

    parts = distinct.select("fit", "x").mapInArrow(sums, "i int, s string")
    rows = {r.i: int(r.s) for r in parts.groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).cast("string").alias("s")).collect()}
    n = rows.pop(-1, 0)
    return n, [rows[i] for i in sorted(rows)]


def _covariance(distinct: DataFrame, n: int, centre: np.ndarray) -> np.ndarray:
    """Products of centred blocks: a task gives one matrix, of which equal rows meet."""
    shared = distinct.sparkSession.sparkContext.broadcast(centre)

    def products(batches):
        total = np.zeros((len(shared.value),) * 2)
        for weight, x, _ in _blocks(batches):
            y = x - shared.value
            total += (y * weight[:, None]).T @ y
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "products"])
        release()

    def added(table):
        return pa.table({"i": table.column("i")[:1], "products": pa.array([matrix(table.column("products")).sum(axis=0)], pa.list_(pa.float64()))})

    kind = "i int, products array<double>"
    parts = distinct.select("fit", "x").mapInArrow(products, kind).groupBy("i").applyInArrow(added, kind).toArrow().sort_by("i")
    v = matrix(parts.column("products")) / n
    return (v + v.T) / 2


def fit(distinct: DataFrame, components: int) -> Fit:
    """Unit eigenvectors of the covariance by falling eigenvalue, divided by the square root of it."""
    n, sums = _sums(distinct)
    found = Fit(n, sums, np.zeros((len(sums), 0)), [])
    v = _covariance(distinct, n, found.centre())
    value, vector = np.linalg.eigh(v)
    order = np.argsort(-value, kind="stable")[:components]
    value, vector, trace = value[order], vector[:, order], float(np.trace(v))
    vector = vector * np.where(vector[np.abs(vector).argmax(axis=0), np.arange(vector.shape[1])] < 0, -1, 1)
    alive = value > max(trace, 0) * len(sums) * np.finfo(float).eps
    found.directions = np.where(alive, vector / np.sqrt(np.where(alive, value, 1)), 0)
    found.explained = [float(e / trace) if a else 0.0 for e, a in zip(value, alive, strict=True)]
    return found


def _whitened(distinct: DataFrame, model: Fit) -> DataFrame:
    """Every distinct vector once: its projections, and its squared distance from the mean times n squared."""
    shared = distinct.sparkSession.sparkContext.broadcast(model)

    def project(batches):
        m = shared.value
        sums, most = np.array(m.sums, object), max(map(abs, m.sums), default=0)
        for _, x, part in _blocks(batches):
            largest = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
            small = m.n * largest + most < 2**62
            off = x * m.n - np.array(m.sums, np.int64) if small else x.astype(object) * m.n - sums
            widest = max(abs(int(off.max())), abs(int(off.min()))) if len(off) else 0
            if widest**2 * len(m.sums) >= 2**62:
                off = off.astype(object)
            deviation = [str(int(v)) for v in (off * off).sum(axis=1)]
            values = (x - m.centre()) @ m.directions
            columns = [part.column(c) for c in ("a", "b", "fit", "copies")]
            columns += [pa.array(list(values), pa.list_(pa.float64())), pa.array(deviation, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "fit", "copies", "values", "deviation"])
        release()

    return saved(distinct.select("a", "b", "fit", "copies", "x").mapInArrow(project, "a long, b long, fit long, copies long, values array<double>, deviation string"), "whitened")


def _identity_error(white: DataFrame, n: int, k: int) -> float:
    """The largest entry of the whitened vectors' covariance less the identity, over the fitted rows."""
    at = [F.get("values", F.lit(i)) for i in range(k)]
    mean = [v or 0.0 for v in white.agg(*[F.sum(F.col("fit") * v) / n for v in at]).first()]
    pairs = [(i, j) for i in range(k) for j in range(i + 1)]
    cov = white.agg(*[F.sum(F.col("fit") * ((at[i] - mean[i]) * (at[j] - mean[j]))) / n for i, j in pairs]).first()
    return max(abs(c - (i == j)) for c, (i, j) in zip(cov, pairs, strict=True))


def _of_length(rows: DataFrame, components: int, weights: str, hot_share: float, hot_least: int) -> DataFrame:
    copies = rows.groupBy("x").agg(F.count(F.lit(1)).alias("copies"))
    fitted = F.col("copies") if weights == "counts" else F.lit(1).cast("long")
    distinct = saved(copies.select("x", "copies", fitted.alias("fit"), *_key()), "distinct")
    model = fit(distinct, components)
    white = _whitened(distinct, model)
    forget(distinct)
    k = len(model.explained)
    error = _identity_error(white, model.n, k)
    every = rows.select("vec_id", *_key())
    total = int(white.agg(F.sum("copies")).first()[0])
    hot = white.where(F.col("copies") > max(total * hot_share, hot_least))  # fewer than 1 / hot_share of them
    kept = ["vec_id", "values", "deviation"]
    joined = every.join(white, ["a", "b"]).select(*kept)
    if hot.count():
        rest = every.join(F.broadcast(hot.select("a", "b")), ["a", "b"], "left_anti")
        joined = rest.join(white, ["a", "b"]).select(*kept).unionByName(every.join(F.broadcast(hot), ["a", "b"]).select(*kept))
    each = joined.select("vec_id", F.col("deviation").cast("decimal(38,0)").alias("deviation_exact"), F.posexplode("values").alias("at", "whitened"))
    return each.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        F.when(F.col("deviation_exact") <= MAX_LONG, F.col("deviation_exact").try_cast("long")).alias("deviation"),
        "whitened",
        F.get(F.array(*[F.lit(e) for e in model.explained]), F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
        "deviation_exact",
    )


def _key():
    return F.xxhash64("x").alias("a"), F.xxhash64(F.lit(1), "x").alias("b")


def whiten(table: DataFrame, components: int = COMPONENTS, weights: str = "counts", hot_share: float = HOT_SHARE, hot_least: int = HOT_LEAST) -> DataFrame:
    """One row per vector and component: what the directions of most variance say of it, scaled to variance 1."""
    if weights not in ("counts", "one"):
        raise ValueError("weights are counts or one")
    rows = finite(table).select("vec_id", "d", F.transform(scaled("v", LARGEST), lambda x: x + SHIFT).alias("x"))
    done = table.sparkSession.createDataFrame([], _RESULT)
    for d in lengths(rows):
        if d:
            done = done.unionByName(_of_length(rows.where(F.col("d") == d), components, weights, hot_share, hot_least))
    return done
