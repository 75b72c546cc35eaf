"""Exact removal of repeated word windows by super-k-mers.

A window is ``k`` consecutive words of one document. Its minimiser is the run of ``m`` words in it with the least hash.
Consecutive windows with the same minimiser travel as one packed string, a super-k-mer, to the bucket of that minimiser;
equal windows have equal minimisers and meet there. In the bucket the windows are sorted, and each run of equal ones has
a first document. The super-k-mers that a slice of a task has for a bucket are one compressed row, equal ones once.

A window whose minimiser is met nowhere else is no copy. So minimisers travel first, alone: each slice sends those it has
once, and says of those it has several times only that they are repeated. Super-k-mers of minimisers that are met once in
all are not sent at all.

Unlike neighbours of one hot passage share its minimiser. Minimisers that are at least ``hot_share`` of the super-k-mers
of some task are hot; that is a bounded list. Their windows go on their own, by their own bytes, as a partial aggregate
that Spark combines before it shuffles and a join that it splits.

Windows are sorted and compared by two independent 64-bit hashes of all their bytes, words being joined by one space.

A word is ``[^\\x20\\x09-\\x0D]+``. Null texts have no words; texts of fewer than ``k`` words have no window. Rows with
the same ``doc_id`` are not earlier than each other; a null ``doc_id`` is later than any other. Extra columns are left.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SECOND, U64, Rolling, keyed, mix, saved, slices, split_words, text_sizes, words_of

K, M = 13, 3
HOT_SHARE, HOT_MOST = 1 / 500, 4_096
PLACE = np.dtype([("doc", "<i8"), ("text", "<i8"), ("pos", "<i4")])
SLICE = 4_000_000


class Windows:
    """Words of some texts, minimisers of their windows, and the super-k-mers these make."""

    def __init__(self, texts: list[str], k: int, m: int):
        self.data, self.start, self.end, self.first = words_of(texts)
        count = np.maximum(np.diff(self.first) - k + 1, 0)  # windows of each text
        self.doc = np.repeat(np.arange(len(texts)), count)
        self.at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(self.first[:-1], count)
        self.k = k
        self.mini, self.breaks = np.zeros(0, U64), np.zeros(1, np.int64)
        if len(self.at):
            word = Rolling(self.data).of(self.start, self.end)
            at = np.arange(len(word) - m + 1)
            grams = mix(Rolling(word).of(at, at + m))
            least = grams[: len(word) - k + 1].copy()
            for d in range(1, k - m + 1):
                np.minimum(least, grams[d : d + len(least)], out=least)
            self.mini = least[self.at]
            change = np.flatnonzero((self.doc[1:] != self.doc[:-1]) | (self.mini[1:] != self.mini[:-1])) + 1
            self.breaks = np.concatenate(([0], change, [len(self.at)]))

    def bytes_of(self, first: np.ndarray, n: np.ndarray):
        """Bytes [a, b) of ``n`` consecutive windows from the given ones on."""
        return self.start[self.at[first]], self.end[self.at[first + n - 1] + self.k - 1]


def _hot_minimisers(rows: DataFrame, k: int, m: int, share: float) -> np.ndarray:
    """Minimisers of at least ``share`` of the super-k-mers of some task; a bounded list."""

    def told(batches):
        seen, total = Counter(), 0
        for part in slices(batches, text_sizes):
            found = Windows(part.column("text").to_pylist(), k, m)
            value, count = np.unique(found.mini[found.breaks[:-1]] if len(found.at) else found.mini, return_counts=True)
            total += int(count.sum())
            often = count * 4 >= share * count.sum()
            seen.update(dict(zip(value[often].view(np.int64).tolist(), count[often].tolist(), strict=True)))
        top = [(v, n) for v, n in seen.items() if n >= max(8, share * total)]
        yield pa.RecordBatch.from_pydict({"mini": pa.array([v for v, _ in top], pa.int64()), "n": pa.array([n for _, n in top], pa.int64())})

    hot = rows.select("text").mapInArrow(told, "mini long, n long").groupBy("mini").agg(F.sum("n").alias("n"))
    return np.sort(np.array([r.mini for r in hot.orderBy(F.desc("n"), "mini").limit(HOT_MOST).collect()], np.int64).view(U64))


def _squeeze(values: np.ndarray | bytes) -> bytes:
    import zstandard

    return zstandard.compress(values if isinstance(values, bytes) else np.ascontiguousarray(values).tobytes(), 3)


def _open(data: bytes, dtype=None):
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(data)
    return raw if dtype is None else np.frombuffer(raw, dtype)


def _groups(sorted_values: np.ndarray):
    """Bounds of the runs of equal values."""
    if not len(sorted_values):
        return []
    head = np.flatnonzero(np.concatenate(([True], sorted_values[1:] != sorted_values[:-1])))
    return list(zip(head.tolist(), np.append(head[1:], len(sorted_values)).tolist(), strict=True))


def _alive(rows: DataFrame, k: int, m: int, buckets: int) -> DataFrame:
    """(doc_key, text_key, alive): the first windows of the super-k-mers whose minimiser is met more than once."""

    def told(batches):
        for part in slices(batches, text_sizes, SLICE):
            found = Windows(part.column("text").to_pylist(), k, m)
            if not len(found.at):
                continue
            first = found.breaks[:-1]
            mini, doc = found.mini[first], found.doc[first]
            place = np.empty(len(first), PLACE)
            place["doc"], place["text"] = part.column("doc_key").to_numpy()[doc], part.column("text_key").to_numpy()[doc]
            place["pos"] = found.at[first] - found.first[doc]
            _, which, count = np.unique(mini, return_inverse=True, return_counts=True)
            often = count[which] > 1
            # a repeated minimiser is told without places, but for its first; its places stay alive anyway
            order = np.argsort(which, kind="stable")
            head = np.zeros(len(first), bool)
            head[order[np.concatenate(([True], np.diff(which[order]) != 0))]] = True
            told_now = np.flatnonzero(head)
            bucket = (mini[told_now] % U64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            told_now, bucket = told_now[order], bucket[order]
            out = []
            for lo, hi in _groups(bucket):
                x = told_now[lo:hi]
                out.append((int(bucket[lo]), _squeeze(mini[x]), _squeeze(often[x]), *(_squeeze(place[c][x]) for c in ("doc", "text", "pos"))))
            rest = np.flatnonzero(often & ~head)
            if len(rest):
                # any bucket will do for what is decided; the slice's own spreads them
                out.append((-1 - int(place["text"][0] % buckets), b"", b"", *(_squeeze(place[c][rest]) for c in ("doc", "text", "pos"))))
            for lo in range(0, len(out), 2_000):
                kinds = (pa.int64(), *[pa.binary()] * 5)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[lo : lo + 2_000], strict=True), kinds, strict=True)], names=["bucket", "mini", "often", "doc", "text", "pos"])

    def repeated(frame):
        cols = {c: frame.column(c).to_pylist() for c in ("mini", "often", "doc", "text", "pos")}
        known = [not x for x in cols["mini"]]
        doc, text, pos = (np.concatenate([_open(x, t) for x in cols[c]]) for c, t in (("doc", "<i8"), ("text", "<i8"), ("pos", "<i4")))
        if all(known):
            keep = np.ones(len(doc), bool)
        else:
            mini = np.concatenate([_open(x, U64) for x in cols["mini"]])
            often = np.concatenate([_open(x, bool) for x in cols["often"]])
            _, which, count = np.unique(mini, return_inverse=True, return_counts=True)
            keep = (count + np.bincount(which, often, len(count)))[which] > 1
        doc, text, pos = doc[keep], text[keep], pos[keep]
        order = np.lexsort((pos, text, doc))
        doc, text, pos = doc[order], text[order], pos[order]
        both = doc ^ mix(text.view(U64)).view(np.int64)
        bounds = _groups(both)
        head = [lo for lo, _ in bounds]
        return pa.table({"doc_key": pa.array(doc[head], pa.int64()), "text_key": pa.array(text[head], pa.int64()), "alive": pa.array([pos[lo:hi].tobytes() for lo, hi in bounds], pa.binary())})

    sent = rows.select("doc_key", "text_key", "text").mapInArrow(told, "bucket long, mini binary, often binary, doc binary, text binary, pos binary")
    parts = sent.groupBy("bucket").applyInArrow(repeated, "doc_key long, text_key long, alive binary")
    return parts.groupBy("doc_key", "text_key").agg(F.collect_list("alive").alias("alive"))


def _super_kmers(rows: DataFrame, k: int, m: int, hot: np.ndarray, only_hot: bool, buckets: int) -> DataFrame:
    """Living super-k-mers with all their places, a row for each slice and bucket; those of hot minimisers window by window."""
    shared = rows.sparkSession.sparkContext.broadcast(hot)

    def cut(batches):
        for part in slices(batches, text_sizes, SLICE):
            found = Windows(part.column("text").to_pylist(), k, m)
            if not len(found.at):
                continue
            first, n = found.breaks[:-1], np.diff(found.breaks)
            living = np.zeros(len(found.at) + 1, bool)
            begin = np.searchsorted(found.doc, np.arange(part.num_rows))
            for i, alive in enumerate(part.column("alive").to_pylist()):
                for x in alive or ():
                    living[begin[i] + np.frombuffer(x, "<i4")] = True
            chosen = living[first] & (np.isin(found.mini[first], shared.value) == only_hot)
            first, n = first[chosen], n[chosen]
            if only_hot:
                first = np.concatenate([np.zeros(0, np.int64), *(np.arange(x, x + y) for x, y in zip(first.tolist(), n.tolist(), strict=True))])
                n = np.ones(len(first), np.int64)
            if not len(first):
                continue
            a, b = found.bytes_of(first, n)
            h, g = Rolling(found.data).of(a, b), Rolling(found.data, SECOND).of(a, b)
            order = np.lexsort((g, h))
            head = np.flatnonzero(np.concatenate(([True], (np.diff(h[order]) != 0) | (np.diff(g[order]) != 0))))
            doc = found.doc[first[order]]
            place = np.empty(len(order), PLACE)
            place["doc"] = part.column("doc_key").to_numpy()[doc]
            place["text"] = part.column("text_key").to_numpy()[doc]
            place["pos"] = found.at[first[order]] - found.first[doc]
            one, raw = order[head], found.data.tobytes()
            ends = np.append(head[1:], len(order))
            packed = [raw[x:y] for x, y in zip(a[one].tolist(), b[one].tolist(), strict=True)]
            if only_hot:
                yield from _hot_rows(packed, place, head, ends)
                continue
            bucket = (found.mini[first][one] % U64(buckets)).astype(np.int64)
            dealt = np.argsort(bucket, kind="stable")
            out = []
            for lo, hi in _groups(bucket[dealt]):
                x = dealt[lo:hi]
                mine = np.concatenate([np.arange(head[i], ends[i]) for i in x])
                strings = b"\n".join([packed[i] for i in x])
                out.append((int(bucket[x[0]]), _squeeze(strings), _squeeze(n[one][x].astype("<i4")), _squeeze((ends - head)[x].astype("<i4")), *(_squeeze(place[c][mine]) for c in ("doc", "text", "pos"))))
            for lo in range(0, len(out), 500):
                kinds = (pa.int64(), *[pa.binary()] * 6)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[lo : lo + 500], strict=True), kinds, strict=True)], names=["bucket", "packed", "n_windows", "n_places", "doc", "text", "pos"])

    if only_hot:
        return rows.mapInArrow(cut, "packed binary, places binary, lo long, hi long")
    return rows.mapInArrow(cut, "bucket long, packed binary, n_windows binary, n_places binary, doc binary, text binary, pos binary")


def _hot_rows(packed, place, head, ends):
    size, raw = PLACE.itemsize, place.tobytes()
    places = [raw[x * size : y * size] for x, y in zip(head.tolist(), ends.tolist(), strict=True)]
    low, high = np.minimum.reduceat(place["doc"], head), np.maximum.reduceat(place["doc"], head)
    for lo in range(0, len(packed), 20_000):
        cut = slice(lo, lo + 20_000)
        yield pa.RecordBatch.from_arrays([pa.array(packed[cut], pa.binary()), pa.array(places[cut], pa.binary()), pa.array(low[cut]), pa.array(high[cut])], names=["packed", "places", "lo", "hi"])


def _sorted_bucket(frame: pa.Table, k: int) -> pa.Table:
    """Sort the windows of a bucket's super-k-mers; the runs of windows whose document is not the first."""
    cols = {c: frame.column(c).to_pylist() for c in frame.column_names}
    raw = b"\n".join(_open(x) for x in cols["packed"]).split(b"\n")
    n, count, pos = (np.concatenate([_open(x, "<i4") for x in cols[c]]).astype(np.int64) for c in ("n_windows", "n_places", "pos"))
    doc, text = (np.concatenate([_open(x, "<i8") for x in cols[c]]) for c in ("doc", "text"))
    place_at = np.cumsum(count) - count
    low, high = np.minimum.reduceat(doc, place_at), np.maximum.reduceat(doc, place_at)
    data, start, end, first = split_words(raw)
    owner = np.repeat(np.arange(len(n)), n)
    begin = np.cumsum(n) - n
    at = np.arange(n.sum()) - np.repeat(begin, n) + np.repeat(first[:-1], n)
    h, g = Rolling(data).of(start[at], end[at + k - 1]), Rolling(data, SECOND).of(start[at], end[at + k - 1])
    order = np.lexsort((g, h))
    head = np.flatnonzero(np.concatenate(([True], (np.diff(h[order]) != 0) | (np.diff(g[order]) != 0))))
    least = np.empty(len(order), np.int64)
    least[order] = np.repeat(np.minimum.reduceat(low[owner][order], head), np.diff(np.append(head, len(order))))
    hit = np.flatnonzero(least < high[owner])
    each = count[owner[hit]]
    which = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each) + np.repeat(place_at[owner[hit]], each)
    return _runs(doc[which], text[which], pos[which] + np.repeat(hit - begin[owner[hit]], each), doc[which] > np.repeat(least[hit], each))


def _runs(doc: np.ndarray, text: np.ndarray, pos: np.ndarray, late: np.ndarray) -> pa.Table:
    """Runs of consecutive windows of the same row."""
    doc, text, pos = doc[late], text[late], pos[late]
    order = np.lexsort((pos, text, doc))
    doc, text, pos = doc[order], text[order], pos[order].astype(np.int32)
    new = np.concatenate(([True], (np.diff(doc) != 0) | (np.diff(text) != 0) | (np.diff(pos) > 1))) if len(doc) else np.zeros(0, bool)
    head = np.flatnonzero(new)
    last = np.append(head[1:], len(doc)) - 1 if len(doc) else head
    return pa.table({"doc_key": doc[head], "text_key": text[head], "first": pos[head], "last": pos[last]})


def _ragged(places: pa.Array, rows: np.ndarray):
    """Places of the given super-k-mers one after another, and how many each has."""
    raw = places.to_pylist() if not isinstance(places, pa.ChunkedArray) else places.combine_chunks().to_pylist()
    size = np.array([len(x) for x in raw], np.int64) // PLACE.itemsize
    begin = np.cumsum(size) - size
    count = size[rows]
    index = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(begin[rows], count)
    return np.frombuffer(b"".join(raw), PLACE)[index], count


RUN = "doc_key long, text_key long, first int, last int"
#: Buckets of a shuffle partition: each is sorted on its own, so that a task holds little at a time.
BUCKETS_EACH = 8


def repeated_windows(docs: DataFrame, k: int = K, m: int = M, hot_share: float = HOT_SHARE) -> DataFrame:
    """Runs of windows, by their first words, that also start in an earlier document."""
    rows = keyed(docs)
    hot = _hot_minimisers(rows, k, m, hot_share)
    buckets = BUCKETS_EACH * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    alive = saved(_alive(rows, k, m, buckets), "minimisers")
    living = rows.join(alive, ["doc_key", "text_key"])  # with all columns: the last join takes the rows as dealt out here
    cold = _super_kmers(living, k, m, hot, False, buckets)
    runs = cold.groupBy("bucket").applyInArrow(lambda frame: _sorted_bucket(frame, k), RUN)
    if not len(hot):
        return runs
    windows = _super_kmers(living, k, m, hot, True, buckets)
    least = windows.groupBy("packed").agg(F.min("lo").alias("least"))

    def late(batches):
        for batch in batches:
            place, count = _ragged(batch.column("places"))
            least = np.repeat(batch.column("least").to_numpy(), count)
            yield from _runs(place["doc"], place["text"], place["pos"], place["doc"] > least).to_batches()

    hot_runs = windows.join(least, "packed").where("hi > least").select("places", "least").mapInArrow(late, RUN)
    return runs.unionByName(hot_runs)


def _ragged(places: pa.Array):
    """Places of all rows one after another, and how many each row has."""
    raw = places.to_pylist()
    return np.frombuffer(b"".join(raw), PLACE), np.array([len(x) for x in raw], np.int64) // PLACE.itemsize


def remove_repeated_windows(docs: DataFrame, k: int = K, m: int = M, hot_share: float = HOT_SHARE) -> DataFrame:
    """Per document: words, words removed, what is left (words joined by one space)."""
    runs = repeated_windows(docs, k, m, hot_share).groupBy("doc_key", "text_key")
    runs = runs.agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    rows = keyed(docs).join(runs, ["doc_key", "text_key"], "left")

    def kept(batches):
        for part in slices(batches, text_sizes):
            n_words, n_removed, left = [], [], []
            for text, found in zip(part.column("text").to_pylist(), part.column("runs").to_pylist(), strict=True):
                words = text.encode().split()
                n_words.append(len(words))
                keep = np.ones(len(words), bool)
                for run in found or ():
                    keep[run["first"] : run["last"] + k] = False
                n_removed.append(len(words) - int(keep.sum()))
                left.append(b" ".join(words if not found else [w for w, x in zip(words, keep.tolist(), strict=True) if x]).decode())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(left, pa.large_string()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])

    return rows.mapInArrow(kept, "doc_id long, n_words long, n_removed long, kept string")
