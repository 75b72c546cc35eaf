"""Removal of long repeated byte strings, by sampled anchors whose blocks are refined by hashes of longer prefixes.

No Burrows-Wheeler transform, interleave or common-prefix array is built. A shard is a slice of a task, and
long texts are cut into several, each window whole in one of them, so what a task holds does not grow with them. Its suffixes are sampled: of every window of ``length`` bytes the least hash of ``GRAM``
bytes in its first ``SPAN`` places is the window's anchor, so equal windows have their anchors at the same place, and
consecutive windows with one anchor are one run. The shard keeps the suffixes that start at anchors, with the symbols a
merge asks for: hashes of longer and longer prefixes, and of all that the run's windows cover, to the left too.

A round splits the blocks of suffixes that agree so far, over all shards, by the hash of their next longer prefix, which
is an aggregate of block counts that each task combines first; suffixes alone in their block leave. So the common prefix of what is left is known after each round, and after the last one every block holds
suffixes that share all bytes which their windows have in common. In a block, suffixes whose runs are equal
to the left and right as well are repeated in full. Where a block holds different runs, one of each is compared window
by window: the windows of a bucket of blocks are sorted by two 64-bit hashes of their bytes. Blocks of more than
``WIDE`` different runs do not go to one bucket: their windows are counted one by one, by their hashes.

Texts are UTF-8 bytes; null texts are empty; texts shorter than ``length`` keep all. Matches do not cross documents.
Rows equal in id and text are documents of their own. A null ``doc_id`` is kept. Extra columns are left behind, but for
``remove``, which keeps them.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MAX_LONG, SECOND, U64, Rolling, forget, keyed, mix, saved, slices, text_sizes

LENGTH = 400
GRAM, ROUNDS = 16, 2
#: Different runs of a block above which its windows are counted one by one: that many are 6 MB in a task.
WIDE = 10_000
BUCKETS_EACH = 16
#: Bytes of a shard, whose arrays take about 130 for each.
SHARD = 200_000
KEY = ["doc_key", "text_key"]
RUN = "doc_key long, text_key long, first int, last int"


def pieces(texts: list[str], length: int, most: int = SHARD):
    """Lists of (number of the text, place in it, bytes) in which about ``most`` windows start, each in one piece and whole."""
    held, size = [], 0
    for nth, text in enumerate(texts):
        raw = text.encode()
        for at in range(0, len(raw) - length + 1, most):
            one = raw[at : at + most + length - 1]
            if held and size + len(one) > most:
                yield held
                held, size = [], 0
            held.append((nth, at, one))
            size += len(one)
    if held:
        yield held


def sliding_argmin(x: np.ndarray, span: int) -> np.ndarray:
    """Place of the least value, the first of equals, in each run of ``span`` values."""
    n = len(x)
    bits = U64(max(24, int(n).bit_length()))  # the same for all slices, so equal windows agree
    key = (x >> bits << bits) | np.arange(n, dtype=U64)
    rows = -(-n // span)
    padded = np.full(rows * span, np.iinfo(U64).max, U64)
    padded[:n] = key
    block = padded.reshape(rows, span)
    ahead = np.minimum.accumulate(block, axis=1).reshape(-1)
    behind = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    starts = n - span + 1
    return (np.minimum(behind[:starts], ahead[span - 1 : span - 1 + starts]) & ((U64(1) << bits) - U64(1))).astype(np.int64)


class Shard:
    """Runs of windows of some pieces by their anchors."""

    def __init__(self, held: list[tuple[int, int, bytes]], length: int):
        self.data = np.frombuffer(b"".join(raw for _, _, raw in held), np.uint8)
        size = np.array([len(raw) for _, _, raw in held], np.int64)
        begin = np.cumsum(size) - size
        self.length, self.span = length, length // 2
        count = size - length + 1
        piece = np.repeat(np.arange(len(held), dtype=np.int32), count)
        start = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(begin, count)
        gram = min(GRAM, length - self.span + 1)
        at = np.arange(len(self.data) - gram + 1)
        self.roll, self.other = Rolling(self.data), Rolling(self.data, SECOND)
        anchor = sliding_argmin(self.roll.of(at, at + gram), self.span)[start]
        new = np.concatenate(([True], (np.diff(anchor) != 0) | (np.diff(piece) != 0)))
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(start)) - 1
        self.first, self.last, self.anchor, of = start[head], start[tail], anchor[head], piece[head]
        self.doc = np.array([nth for nth, _, _ in held])[of]
        self.base = (begin - np.array([at for _, at, _ in held]))[of]

    def hashes(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix(self.roll.of(a, b) ^ mix(self.other.of(a, b)))

    def rounds(self, rounds: int) -> list[np.ndarray]:
        """Hashes of prefixes from the anchor on, up to all that the run's windows have in common."""
        common = self.length - self.span + 1
        return [self.hashes(self.anchor, self.anchor + common * (k + 1) // rounds) for k in range(rounds)]

    def whole(self) -> np.ndarray:
        """Hash of all bytes that the windows of a run cover, and where in them they start."""
        place = (self.anchor - self.first).astype(U64) * U64(SECOND) + (self.last - self.first).astype(U64)
        return mix(self.hashes(self.first, self.last + self.length) + place)


def sampled(texts: list[str], length: int, rounds: int):
    """For each shard of some texts: the text of each run, its first and last window, and its hashes."""
    for held in pieces(texts, length):
        shard = Shard(held, length)
        keys = shard.rounds(rounds)
        order = np.argsort(keys[-1], kind="stable")  # the shard's own order of blocks
        first, last = ((x - shard.base)[order].astype(np.int32) for x in (shard.first, shard.last))
        yield shard.doc[order], first, last, [x[order].view(np.int64) for x in (*keys, shard.whole())]


def suffixes(rows: DataFrame, length: int, rounds: int = ROUNDS) -> DataFrame:
    """Sampled suffixes (doc_key, text_key, first, last, k0.., whole): one row for each run of windows."""
    names = [f"k{i}" for i in range(rounds)]

    def build(batches):
        for part in slices(batches, text_sizes, 1_000_000):
            keys = [part.column(c).to_numpy() for c in KEY]
            for doc, first, last, hashes in sampled(part.column("text").to_pylist(), length, rounds):
                cols = [pa.array(x) for x in (*(k[doc] for k in keys), first, last, *hashes)]
                yield pa.RecordBatch.from_arrays(cols, names=[*KEY, "first", "last", *names, "whole"])

    schema = "doc_key long, text_key long, first int, last int, " + ", ".join(f"{n} long" for n in names) + ", whole long"
    return rows.select("text", *KEY).mapInArrow(build, schema)


def refine(found: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Suffixes that share a block with others after all rounds; ``found`` is a written table and goes."""
    for k in range(rounds):
        # written, so that both sides of the join are plain reads, which Spark splits at blocks of very many suffixes
        block = saved(found.groupBy(f"k{k}").agg(F.count("*").alias("n")).where("n > 1").select(f"k{k}"), "blocks")
        left = found.join(block, f"k{k}", "left_semi")
        left = saved(left.drop(f"k{k}") if k < rounds - 1 else left.withColumnRenamed(f"k{k}", "block"), "suffixes")
        forget(found, block)
        found = left
    return found


def _window_hashes(data: np.ndarray, start: np.ndarray, size: np.ndarray, length: int):
    """Two hashes of every window of some strings, and the string and place of each."""
    count = size - length + 1
    owner = np.repeat(np.arange(len(size)), count)
    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    at = start[owner] + nth
    return Rolling(data).of(at, at + length), Rolling(data, SECOND).of(at, at + length), owner, nth


def _runs(doc, text, pos) -> pa.Table:
    order = np.lexsort((pos, text, doc))
    doc, text, pos = doc[order], text[order], pos[order].astype(np.int32)
    new = np.concatenate(([True], (np.diff(doc) != 0) | (np.diff(text) != 0) | (np.diff(pos) > 1))) if len(doc) else np.zeros(0, bool)
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(doc)) - 1 if len(doc) else head
    return pa.table({"doc_key": doc[head], "text_key": text[head], "first": pos[head], "last": pos[tail]})


def _compare(frame: pa.Table, length: int) -> pa.Table:
    """Windows of a bucket's different runs that another of them has too, where the run is alone in its class."""
    raw = frame.column("bytes").to_pylist()
    size = np.array([len(r) for r in raw], np.int64)
    h, g, owner, nth = _window_hashes(np.frombuffer(b"".join(raw), np.uint8), np.cumsum(size) - size, size, length)
    order = np.lexsort((g, h))
    same = (np.diff(h[order]) == 0) & (np.diff(g[order]) == 0)
    hit = np.zeros(len(order), bool)
    hit[order[1:][same]] = hit[order[:-1][same]] = True
    hit &= frame.column("alone").to_numpy()[owner]
    at = owner[hit]
    return _runs(*(frame.column(c).to_numpy()[at] for c in KEY), frame.column("first").to_numpy()[at] + nth[hit])


def repeated(docs: DataFrame, length: int = LENGTH, rounds: int = ROUNDS, wide: int = WIDE) -> DataFrame:
    """Runs (doc_key, text_key, first, last) of places where a string starts that also starts elsewhere."""
    rows = keyed(docs)
    found = refine(saved(suffixes(rows, length, rounds), "suffixes"), rounds)
    classes = found.groupBy("block", "whole").agg(F.count("*").alias("n"), F.min(F.struct(*KEY, "first", "last")).alias("one"))
    blocks = classes.groupBy("block").agg(F.count("*").alias("kinds"))
    classes = saved(classes.join(blocks, "block"), "blocks")
    full = found.join(classes.where("n > 1").select("block", "whole"), ["block", "whole"], "left_semi").select(*KEY, "first", "last")
    # one run of each class where there are several
    ones = classes.where("kinds > 1").select("block", F.col("n").alias("n"), "kinds", "one.*")
    wanted = ones.groupBy(*KEY).agg(F.collect_list(F.struct("block", (F.col("n") == 1).alias("alone"), (F.col("kinds") > wide).alias("wide"), "first", "last")).alias("runs"))
    held = rows.join(wanted, KEY)  # with all columns, so that the rows are dealt out once for this and for the last join

    def cut(batches):
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.int32(), pa.binary())
        def told(part):
            for doc, text_key, text, runs in zip(*(part.column(c).to_pylist() for c in (*KEY, "text", "runs")), strict=True):
                raw = text.encode()
                for r in runs:
                    yield doc, text_key, r["block"], r["alone"], r["wide"], r["first"], raw[r["first"] : r["last"] + length]

        for part in slices(batches, text_sizes, SHARD):
            for out in itertools.batched(told(part), 5_000):
                cols = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=[*KEY, "block", "alone", "wide", "first", "bytes"])

    strings = held.mapInArrow(cut, "doc_key long, text_key long, block long, alone boolean, wide boolean, first int, bytes binary")
    buckets = BUCKETS_EACH * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    narrow = strings.where("not wide").drop("wide").withColumn("bucket", F.pmod("block", F.lit(buckets)))
    some = narrow.groupBy("bucket").applyInArrow(lambda frame: _compare(frame, length), RUN)
    return full.unionByName(some).unionByName(_wide(strings.where("wide"), length))


def _wide(strings: DataFrame, length: int) -> DataFrame:
    def windows(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 2_000):
                part = batch.slice(lo, 2_000)
                raw = part.column("bytes").to_pylist()
                size = np.array([len(r) for r in raw], np.int64)
                h, g, owner, nth = _window_hashes(np.frombuffer(b"".join(raw), np.uint8), np.cumsum(size) - size, size, length)
                cols = [pa.array(part.column(c).to_numpy(zero_copy_only=False)[owner]) for c in (*KEY, "alone")]
                pos = (part.column("first").to_numpy()[owner] + nth).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*cols, pa.array(h.view(np.int64)), pa.array(g.view(np.int64)), pa.array(pos)], names=[*KEY, "alone", "h", "g", "first"])

    every = strings.select(*KEY, "alone", "first", "bytes").mapInArrow(windows, "doc_key long, text_key long, alone boolean, h long, g long, first int")
    # a run stands for its class, so a window that one row has twice is two places of it
    more = every.groupBy("h", "g").agg(F.count("*").alias("n")).where("n > 1").select("h", "g")
    return every.where("alone").join(more, ["h", "g"], "left_semi").select(*KEY, "first", F.col("first").alias("last"))


def _covered(size: int, runs, length: int) -> np.ndarray:
    """Which bytes go."""
    edge = np.zeros(size + 1, np.int64)
    for r in runs or ():
        edge[r["first"]] += 1
        edge[r["last"] + length] -= 1
    return np.cumsum(edge[:-1]) > 0


def _with_runs(docs: DataFrame, length: int) -> DataFrame:
    """The rows with the list of their runs."""
    runs = repeated(docs, length).groupBy(*KEY).agg(F.collect_list(F.struct("first", "last")).alias("__runs"))
    runs = runs.select(F.col("doc_key").alias("__doc"), F.col("text_key").alias("__text"), "__runs")
    rows = docs.withColumns({"__doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(MAX_LONG)), "__text": F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))})
    return rows.join(runs, ["__doc", "__text"], "left").drop("__doc", "__text")


def repeated_bytes(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per document: bytes, bytes removed, maximal removed runs, and the bytes that are left."""
    runs = repeated(docs, length).groupBy(*KEY).agg(F.collect_list(F.struct("first", "last")).alias("__runs"))
    rows = keyed(docs).join(runs, KEY, "left")

    def cut(batches):
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        for part in slices(batches, text_sizes):
            out = []
            for doc, text, runs in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "__runs")), strict=True):
                raw = text.encode()
                if runs:
                    gone = _covered(len(raw), runs, length)
                    spans = int(np.count_nonzero(np.diff(np.concatenate(([0], gone.view(np.int8)))) == 1))
                    out.append((doc, len(raw), int(gone.sum()), spans, np.frombuffer(raw, np.uint8)[~gone].tobytes()))
                else:
                    out.append((doc, len(raw), 0, 0, raw))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return rows.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def remove(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The documents without repeated strings, with all their columns; ``n_chars`` follows the text.

    A character of which a byte goes, goes whole. A text of which nothing is left stays as an empty one.
    """
    names = docs.columns

    def cut(batches):
        for batch in slices(batches, text_sizes):
            texts, runs = batch.column("text").to_pylist(), batch.column("__runs").to_pylist()
            for i, r in enumerate(runs):
                if r:
                    raw = np.frombuffer(texts[i].encode(), np.uint8)
                    texts[i] = raw[~_covered(len(raw), r, length)].tobytes().decode("utf-8", "ignore")
            cols = {n: batch.column(n) for n in names} | {"text": pa.array(texts, batch.schema.field("text").type)}
            if "n_chars" in names:
                kind = batch.schema.field("n_chars").type
                n_chars = batch.column("n_chars").to_pylist()
                cols["n_chars"] = pa.array([len(t) if r else n for t, r, n in zip(texts, runs, n_chars, strict=True)], kind)
            yield pa.RecordBatch.from_pydict(cols)

    return _with_runs(docs, length).mapInArrow(cut, docs.schema)
