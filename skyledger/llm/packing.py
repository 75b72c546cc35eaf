"""Best-fit packing of documents into sequences of a fixed number of tokens, improved by swap-based local search.

Documents are encoded, ended by ``end_id`` and, only if longer than a sequence, cut into full pieces; what is left over
is the first piece. Full pieces are sequences of their own. The others are dealt by a hash of their key, and of their
number among equal ones, into groups of about ``group_rows`` pieces, and each group is packed on its own: best fit by
decreasing length, then local search between underfull bins. A step moves a piece, or exchanges one for one, one for two
or two for one, if the sum of squared fills grows; emptied bins vanish. Bins that stay underfull give their pieces to the
next round, whose groups may double, but to no more than about ``most_rows`` pieces. The last round has one group, or it
is one that settled little and whose groups cannot double: its underfull bins stay as they are. So the pieces of a task
are bounded whatever their lengths, and where lengths rarely add up to a whole sequence, bins stay underfull.

Nulls are empty texts (one piece that holds ``end_id``); repeated rows are packed like any other; a null ``doc_id`` is
kept. No documents: no pieces. Ties between equal lengths go by key, so results do not depend on the partitioning.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import byte_bpe
from .common import documents, saved

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
COLUMNS = ("doc_id", "piece", "start", "length", "ids_crc32")
#: Steps of the local search in a group, at least; a group of more pieces has one for each.
SEARCH_STEPS = 4_000
#: A round that settles a smaller share of its pieces settled little.
LITTLE = 0.1


def pieces(docs: DataFrame, capacity: int = 1024, end_id: int = 2, tokenizer: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """One row per piece: its document, number, place among the document's ids, length and checksum of its ids."""
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches):
        coder = byte_bpe.load(tokenizer)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part, rows = batch.slice(lo, 1000), []
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    ids = coder.encode(text) + end
                    n = len(ids) // 4
                    places = [0, *range(n % capacity or capacity, n, capacity), n] if n > capacity else [0, n]
                    rows += [(doc_id, k, a, b - a, zlib.crc32(ids[4 * a : 4 * b])) for k, (a, b) in enumerate(zip(places, places[1:], strict=False))]
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return documents(docs).mapInArrow(cut, PIECE)


class Bins:
    """Bins with a fixed capacity, found by their free room."""

    def __init__(self, capacity: int):
        self.capacity, self.mask = capacity, 0
        self.items: dict[int, list[int]] = {}
        self.free: dict[int, int] = {}
        self.by_free: dict[int, dict[int, None]] = defaultdict(dict)

    def _leave(self, b: int) -> None:
        f = self.free[b]
        del self.by_free[f][b]
        if not self.by_free[f]:
            self.mask &= ~(1 << f)

    def _enter(self, b: int, f: int) -> None:
        self.free[b] = f
        self.by_free[f][b] = None
        self.mask |= 1 << f

    def fit(self, length: int, other_than: int = -1) -> int | None:
        """The bin with the least room that still holds ``length``."""
        mask = self.mask >> length << length
        while mask:
            f = (mask & -mask).bit_length() - 1
            b = next((b for b in self.by_free[f] if b != other_than), None)
            if b is not None:
                return b
            mask &= mask - 1
        return None

    def change(self, b: int, out: list[int], into: list[int], lengths) -> None:
        if b not in self.items:
            self.items[b] = []
            self._enter(b, self.capacity)
        room = self.free[b] + sum(int(lengths[i]) for i in out) - sum(int(lengths[i]) for i in into)
        self._leave(b)
        for i in out:
            self.items[b].remove(i)
        self.items[b] += into
        self._enter(b, room)
        if not self.items[b]:
            self._leave(b)
            del self.items[b], self.free[b]


def best_fit(lengths: np.ndarray, capacity: int) -> Bins:
    bins = Bins(capacity)
    for i in np.argsort(-lengths, kind="stable").tolist():
        b = bins.fit(int(lengths[i]))
        bins.change(len(bins.items) if b is None else b, [], [i], lengths)
    return bins


def _unlike(items: list[int], lengths, most: int = 2) -> list[int]:
    """Pieces of a bin of which at most ``most`` have the same length: no pair of lengths is lost, and few are left."""
    seen: dict[int, int] = defaultdict(int)
    out = []
    for i in items:
        seen[n := int(lengths[i])] += 1
        if seen[n] <= most:
            out.append(i)
    return out


def improve(bins: Bins, lengths: np.ndarray, steps: int | None = None) -> None:
    """Empty the least filled bins into fuller ones; each step makes the sum of squared fills grow.

    A pass goes over the underfull bins once, emptiest first. It ends the search if no bin vanished, or if so little
    room is left that none can.
    """
    lengths = np.asarray(lengths, np.int64)
    steps = max(SEARCH_STEPS, len(lengths)) if steps is None else steps
    while steps > 0 and sum(bins.free.values()) >= bins.capacity:
        before = len(bins.items)
        under = sorted((b for b, f in bins.free.items() if f), key=lambda b: (-bins.free[b], b))
        singles = np.array([i for b in under for i in bins.items[b]], np.int64)
        pairs = np.array([p for b in under for p in combinations(_unlike(bins.items[b], lengths), 2)], np.int64).reshape(-1, 2)
        owner = np.zeros(len(lengths), np.int64)
        room = np.zeros(max(bins.items) + 1, np.int64)
        for b in under:
            owner[bins.items[b]], room[b] = b, bins.free[b]

        def go(source, target, out, into, owner=owner, room=room):
            bins.change(target, into, out, lengths)
            bins.change(source, out, into, lengths)
            owner[out], owner[into] = target, source
            for b in (source, target):
                room[b] = bins.free.get(b, 0)

        for source in under:
            while source in bins.items and steps > 0:
                steps -= 1
                found = _step(bins, source, singles, pairs, owner, room, lengths)
                if not found:
                    break
                go(source, *found)
        if len(bins.items) == before:
            return


def _step(bins: Bins, source: int, singles, pairs, owner, room, lengths):
    """A fuller bin, what it gets from ``source`` and what it gives back; the exchange that fills it best."""
    mine = sorted(bins.items[source], key=lambda i: (-lengths[i], i))
    for i in _unlike(mine, lengths, 1):
        target = bins.fit(int(lengths[i]), other_than=source)
        if target is not None and bins.free[target] <= bins.free[source]:
            return target, [i], []
    single, double, sum_single = owner[singles], owner[pairs[:, 0]], lengths[singles]
    open_single = np.where((single != source) & (room[single] <= room[source]), room[single], 0)
    open_double = np.where((double != source) & (double == owner[pairs[:, 1]]) & (room[double] <= room[source]), room[double], 0)
    sum_double = lengths[pairs].sum(axis=1)
    for i in _unlike(mine, lengths, 1):
        for of, sums, rooms in ((singles, sum_single, open_single), (pairs, sum_double, open_double)):
            gain = lengths[i] - sums
            gain[gain > rooms] = 0
            if len(gain) and gain[best := int(gain.argmax())] > 0:
                into = np.atleast_1d(of[best]).tolist()
                return int(owner[into[0]]), [i], into
    for i, j in combinations(_unlike(mine, lengths), 2):
        gain = lengths[i] + lengths[j] - sum_single
        gain[gain > open_single] = 0
        if len(gain) and gain[best := int(gain.argmax())] > 0:
            return int(single[best]), [i, j], [int(singles[best])]
    return None


def pack_group(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of every piece, and whether its bin is full."""
    bins = best_fit(lengths, capacity)
    improve(bins, lengths)
    number, offset, full = (np.zeros(len(lengths), np.int64) for _ in range(3))
    for n, b in enumerate(bins.items):
        at = 0
        for i in bins.items[b]:
            number[i], offset[i], full[i] = n, at, bins.free[b] == 0
            at += int(lengths[i])
    return number, offset, full.astype(bool)


def _round(rows: DataFrame, groups: int, nth: int, capacity: int) -> DataFrame:
    schema = f"{PIECE}, copy long, sequence_id long, offset long, settled boolean"

    def packed(key, frame):
        order = [(c, "ascending") for c in (*COLUMNS, "copy")]
        frame = frame.select([c for c, _ in order]).sort_by(order)
        number, offset, full = pack_group(frame.column("length").to_numpy(), capacity)
        # a group has its own range of numbers, and so has each round
        ids = ((np.int64(nth) << 52) | (np.int64(key[0].as_py()) << 24)) + number
        for name, values in (("sequence_id", ids), ("offset", offset), ("settled", full)):
            frame = frame.append_column(name, pa.array(values))
        return frame

    return rows.withColumn("g", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "copy", F.lit(nth)), F.lit(groups))).groupBy("g").applyInArrow(packed, schema)


def pack(rows: DataFrame, n_rows: int, capacity: int = 1024, group_rows: int = 20_000, most_rows: int = 20_000) -> DataFrame:
    """Pack pieces; ``n_rows`` (about the number of short pieces) sets the number of groups of the first round."""
    # equal rows are numbered, or the hash would put all of them into one group
    rows = saved(rows.groupBy(*COLUMNS).count().select(*COLUMNS, F.explode(F.sequence(F.lit(1).cast("long"), "count")).alias("copy")), "pieces")
    out = rows.where(F.col("length") >= capacity).select(*COLUMNS, F.lit(None).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    # the smallest number is the piece's own: of rows as these there may be many, and partitions number theirs apart
    out = out.withColumn("sequence_id", -1 - F.monotonically_increasing_id())
    rest, nth, groups, here = rows.where(F.col("length") < capacity), 0, max(1, -(-n_rows // group_rows)), n_rows
    while True:
        done = saved(_round(rest, groups, nth, capacity), "packed")
        left = 0 if groups == 1 else done.where("not settled").count()
        fewer = max(1, -(-left // max(group_rows, most_rows)), min(groups // 2, -(-left // group_rows)))
        if groups == 1 or left > (1 - LITTLE) * here and fewer > groups // 2:
            return out.unionByName(done.drop("copy", "settled"))
        out = out.unionByName(done.where("settled").drop("copy", "settled"))
        rest, nth, groups, here = done.where("not settled").drop("sequence_id", "offset", "settled"), nth + 1, fewer, left


def best_fit_packing(docs: DataFrame, capacity: int = 1024, end_id: int = 2, group_rows: int = 20_000) -> DataFrame:
    """Pieces of all documents with ``sequence_id`` and ``offset``."""
    return pack(pieces(docs, capacity, end_id), docs.count(), capacity, group_rows)
