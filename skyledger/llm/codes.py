"""Vector codes by member-resident Lloyd: every part of a vector stays with the entry it is nearest to.

Components become integers, ``floor(1024 * x)``, and a vector is cut into consecutive parts. A part is a *member* of one
entry of the codebook of its position, and members lie in files partitioned by (position, entry, salt): the owner of an
entry is whichever task reads its files. A round has three steps, each of which ends in a written table:

* *assign*: tasks read the members where they lie and compare them with the codebook of their position, which is
  broadcast: ``parts * entries`` rows of ``d / parts`` integers, whatever the input. Members whose entry stays the same
  are written on by the task that holds them and are not shuffled.
* *migrate*: only the members that changed their entry are shuffled, to their new (position, entry, salt). The number of
  salts of an entry follows from how many members arrive, so that no owner takes more than about ``owner_rows`` at once:
  an entry that a third of all rows are nearest to is spread over many tasks.
* *update*: owners sum up their resident members, one row of sums per entry and task; the sums of an entry's salts are
  added, and the entry becomes ``floor(sum / count)``. Entries without members stay.

After the last round parts are assigned once more, and the codes of a vector's parts meet by row.

All of this is in whole numbers of any size, so results do not depend on partitioning. Components beyond 2**62 are taken
for that. Each length of vectors has its own codebooks; a length that the number of parts doesn't divide gives parts that
differ by one. Null ids sort last and are kept, equal rows get equal codes, empty vectors have code 0 and error 0, fewer
rows than entries give as many entries as rows, and an error beyond the largest long is that. An empty table has no codes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import work_folder
from .common import MAX_LONG, forget, release, saved
from .vectors import exact_sums, finite, lengths, matrix, scaled

PARTS, ENTRIES, ROUNDS = 4, 256, 4
#: Members that come to one (position, entry, salt), about.
OWNER_ROWS = 100_000
LARGEST = 2**62
#: Rows of a batch that are compared with a codebook at a time.
BLOCK = 4_096


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """The nearest entry of each row and its squared distance; ties go to the lower index."""
    top = max([abs(int(v)) for a in (x, book) if a.size for v in (a.max(), a.min())], default=0)
    if top * top * 4 * max(x.shape[1], 1) < 2**53:
        x, book = x.astype(float), book.astype(float)  # whole numbers below 2**53: the products are exact
        far = np.einsum("nd,nd->n", x, x)[:, None] - 2 * (x @ book.T) + np.einsum("nd,nd->n", book, book)[None]
        at = far.argmin(axis=1)
        return at, far[np.arange(len(x)), at].astype(np.int64).tolist()
    x, book = x.astype(object), book.astype(object)
    at, error = np.zeros(len(x), np.int64), []
    for i, row in enumerate(x):
        far = ((book - row) ** 2).sum(axis=1)
        at[i] = min(range(len(far)), key=far.__getitem__)
        error.append(int(far[at[i]]))
    return at, error


def cut(d: int, parts: int) -> list[int]:
    return [p * d // parts for p in range(parts + 1)]


def _members(rows: DataFrame, edges: list[int]) -> DataFrame:
    """One row per part of a vector; id and label travel with the first part only."""
    parts = F.array(*[F.slice("x", a + 1, b - a) for a, b in zip(edges, edges[1:], strict=False)])
    each = rows.select("row", "vec_id", "label", F.posexplode(parts).alias("position", "part"))
    first = F.col("position") == 0
    return each.select("row", F.when(first, F.col("vec_id")).alias("vec_id"), F.when(first, F.col("label")).alias("label"), "position", F.lit(-1).alias("entry"), "part")


def _assigned(members: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """Members with the entry they are nearest to now, the squared distance as text, and whether the entry has changed."""
    shared = members.sparkSession.sparkContext.broadcast(books)
    names = members.columns

    def assign(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                position = part.column("position").to_numpy()
                entry, error = np.zeros(len(position), np.int32), np.zeros(len(position), object)
                for p in np.unique(position).tolist():
                    mine = np.flatnonzero(position == p)
                    found, far = nearest(matrix(part.column("part").take(pa.array(mine))), shared.value[p])
                    entry[mine] = found
                    error[mine] = far
                moved = entry != part.column("entry").to_numpy()
                columns = [pa.array(entry, pa.int32()) if name == "entry" else part.column(name) for name in names]
                columns += [pa.array([str(e) for e in error], pa.string()), pa.array(moved)]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "error", "moved"])
        release()

    kinds = {f.name: f.dataType.simpleString() for f in members.schema}
    return members.mapInArrow(assign, ", ".join(f"`{k}` {v}" for k, v in kinds.items()) + ", error string, moved boolean")


def _split(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Write members where they are; return those that stay with their owner and those that are to migrate."""
    spark, root = members.sparkSession, work_folder(members.sparkSession, "members")
    members.write.partitionBy("moved").parquet(root)
    table = spark.read.schema(members.schema).parquet(root)
    stay, move = (table.where(F.col("moved") == m).drop("moved", "error") for m in (False, True))
    stay.saved_at, move.saved_at = root, f"{root}/moved=true"
    return stay, move


def _migrate(move: DataFrame, owner_rows: int) -> DataFrame:
    """Members at their new owners; the count of arrivals has at most ``parts * entries`` rows."""
    arrive = move.groupBy("position", "entry").count().withColumn("salts", F.ceil(F.col("count") / owner_rows)).drop("count")
    salted = move.join(F.broadcast(arrive), ["position", "entry"]).withColumn("salt", F.pmod(F.xxhash64("row"), "salts"))
    there = salted.repartition("position", "entry", "salt").sortWithinPartitions("position", "entry")
    return saved(there.select(*move.columns), "arrived")


def _updated(residents: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """Codebooks whose entries are the means of their resident members, rounded down."""

    def sums(batches):
        total: dict[tuple[int, int], list] = {}
        for batch in batches:
            position, entry = (batch.column(c).to_numpy() for c in ("position", "entry"))
            owner = position.astype(np.int64) << 32 | entry
            order = np.argsort(owner, kind="stable")
            begins = np.flatnonzero(np.diff(owner[order], prepend=-1))
            for mine in np.split(order, begins[1:]) if len(order) else []:
                key = int(position[mine[0]]), int(entry[mine[0]])
                new = exact_sums(matrix(batch.column("part").take(pa.array(mine))))
                n, old = total.get(key, (0, [0] * len(new)))
                total[key] = n + len(mine), [a + b for a, b in zip(old, new, strict=True)]
        rows = [(p, e, n, [str(s) for s in values]) for (p, e), (n, values) in total.items()]
        for at in range(0, len(rows), 256):
            cols = list(zip(*rows[at : at + 256], strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.string())), strict=True)], names=["position", "entry", "n", "sums"])

    parts = residents.select("position", "entry", "part").mapInArrow(sums, "position int, entry int, n long, sums array<string>")
    each = parts.select("position", "entry", "n", F.posexplode("sums").alias("i", "s"))
    means = each.groupBy("position", "entry", "i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).cast("string").alias("s")).toArrow()
    books = [b.copy() for b in books]
    for p, e, i, n, s in zip(*(means.column(c).to_pylist() for c in ("position", "entry", "i", "n", "s")), strict=True):
        books[p][e, i] = int(s) // n
    return books


def _compressed(rows: DataFrame, d: int, parts: int, entries: int, rounds: int, owner_rows: int) -> DataFrame:
    """Codes of all rows with vectors of one length."""
    edges = cut(d, parts)
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "x", "row").limit(entries).toArrow()
    start = matrix(first.column("x")).astype(np.int64) if d else np.zeros((first.num_rows, 0), np.int64)
    books = [start[:, a:b].copy() for a, b in zip(edges, edges[1:], strict=False)]
    members, held = _members(rows, edges), []
    for _ in range(rounds):
        stay, move = _split(_assigned(members, books))
        arrived = _migrate(move, owner_rows)
        forget(move, *held)
        members, held = stay.unionByName(arrived), [stay, arrived]
        books = _updated(members, books)
    digest = ",".join(str(v) for book in books for entry in book.tolist() for v in entry)
    last = _assigned(members, books)
    codes = [F.max(F.when(F.col("position") == p, F.lpad(F.lower(F.hex("entry")), 2, "0"))) for p in range(parts)]
    error = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(MAX_LONG)).cast("long")
    whole = last.groupBy("row").agg(F.max("vec_id").alias("vec_id"), F.max("label").alias("label"), F.concat(*codes).alias("code"), error.alias("error"))
    done = saved(whole.withColumn("codebooks_sha256", F.lit(hashlib.sha256(digest.encode()).hexdigest())), "codes")
    forget(*held)
    return done


def compress(table: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, owner_rows: int = OWNER_ROWS) -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256) of every row with a finite vector."""
    integers = finite(table).select("vec_id", "label", "d", scaled("v", LARGEST).alias("x"))
    rows = saved(integers.withColumn("row", F.monotonically_increasing_id()), "vectors")
    done = None
    for d in lengths(rows):
        found = _compressed(rows.where(F.col("d") == d), d, parts, entries, rounds, owner_rows)
        done = found if done is None else done.unionByName(found)
    forget(rows)
    if done is None:
        text, empty = F.lit("").alias, table.sparkSession.range(0)
        label = F.lit(None).cast(integers.schema["label"].dataType).alias("label")
        done = empty.select(F.col("id").alias("vec_id"), label, text("code"), F.col("id").alias("error"), text("codebooks_sha256"))
    total = done.groupBy("label").agg(_sum("error").alias("label_error")).withColumnRenamed("label", "of")
    joined = done.join(total, F.col("label").eqNullSafe(F.col("of")))
    return joined.select("vec_id", "label", "code", "error", "label_error", "codebooks_sha256")


def _sum(name: str) -> Column:
    return F.least(F.sum(F.col(name).cast("decimal(38,0)")), F.lit(MAX_LONG)).cast("long")
