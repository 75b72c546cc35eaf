"""Near-duplicates by DartMinHash signatures, banded joining, and an exact check of weighted Jaccard similarity.

A document is a weighted set: its shingles of ``words`` words, weighted by how often they occur (by themselves, so the
weighted Jaccard similarity is that of the multisets). Each element owns a region of the plane, its weight by rank; darts
are thrown into unit cells of it, one Poisson number with mean one per cell, at places that follow from the hash of the
element and cell alone. Only darts below the rank bound that the document's weight calls for are thrown, each falls on
one of ``size`` coordinates, and a coordinate keeps its earliest dart. Where a coordinate stays empty the bound doubles.
So a document costs its number of elements and ``size * log(size)``, and two of them agree on a coordinate with the
probability that is their similarity.

Texts with the same multiset are one node. Nodes meet in buckets, one for each band of ``rows`` coordinates, but never
all with all: members meet a few pivots of their bucket, found links give components, and as long as the members that
were no pivot are in several components, the bucket gets four times as many pivots, those of its smallest components first.
So every two members have met or are in one component when a bucket is done, and a bucket of thousands of copies is done
at once. Members of buckets that are not done after two passes are unlike each other, and would meet all with all. They go on
in buckets of elements: each multiset is in those of its rarest elements only, as many as a similar one must share one of.
A pass is made of aggregates and joins, which Spark splits at hot buckets. Pairs that meet are compared by their signatures,
and the remaining ones exactly on the multisets.

Texts of fewer than ``words`` words are one shingle, of all their words. Documents without words, and those with a null
``doc_id``, are in a class of their own. Null texts are empty. A class is named after its least ``doc_id``; of rows that
share that id, after the one with the least hash of its text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import MAX_LONG, SECOND, U64, Rolling, forget, keyed, mix, saved, slices, text_sizes, words_of
from .components import components

WORDS, THRESHOLD = 5, 0.8
#: Pairs of similarity 0.8 share one of the 21 bands with a chance of 0.998, those of 0.5 with 0.28.
SIZE, ROWS = 126, 6
#: Passes over buckets of bands; after them, members that have not met do so in buckets of their least common elements.
BAND_PASSES = 2
_POISSON = np.cumsum([1, 1, 1 / 2, 1 / 6, 1 / 24, 1 / 120, 1 / 720, 1 / 5040, 1 / 40320]) / np.e


def shingles(texts: list[str], words: int):
    """Hashes of all shingles of some texts, and the text each belongs to."""
    data, start, end, first = words_of(texts)
    n = np.diff(first)
    count = np.where(n >= words, n - words + 1, np.minimum(n, 1))
    doc = np.repeat(np.arange(len(texts)), count)
    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first[:-1], count)
    last = at + np.minimum(words, n[doc]) - 1
    return Rolling(data).of(start[at], end[last]) if len(at) else np.zeros(0, U64), doc


def weigh(element: np.ndarray, doc: np.ndarray):
    """Distinct elements of each document, in order, and their weights."""
    order = np.lexsort((element, doc))
    element, doc = element[order], doc[order]
    head = np.flatnonzero(np.concatenate(([True], (np.diff(doc) != 0) | (np.diff(element) != 0)))) if len(doc) else np.zeros(0, np.int64)
    return element[head], doc[head], np.diff(np.append(head, len(doc))).astype(float)


def signatures(element: np.ndarray, doc: np.ndarray, weight: np.ndarray, n_docs: int, size: int) -> np.ndarray:
    """A row of ``size`` dart identities for every document with a positive weight; zeros for the others."""
    out = np.zeros((n_docs, size), U64)
    total = np.bincount(doc, weight, n_docs)
    todo = np.flatnonzero(total > 0)
    bound = np.zeros(n_docs)
    bound[todo] = size * (np.log(size) + 2) / total[todo]
    # unit cells of weight: the last one of an element may be filled in part
    cells = np.ceil(weight).astype(np.int64)
    of = np.repeat(np.arange(len(doc)), cells)
    level = np.arange(len(of)) - np.repeat(np.cumsum(cells) - cells, cells)
    cell, owner, filled = mix(element[of] ^ mix(level.astype(U64) + U64(1))), doc[of], (weight[of] - level)
    while len(todo):
        best = np.full((n_docs, size), np.inf)
        wanted = np.zeros(n_docs, bool)
        wanted[todo] = True
        part = np.flatnonzero(wanted[owner])
        found: list[tuple] = []
        column = 0
        while len(part):
            # cells of rank [column, column + 1) for documents whose bound reaches there
            part = part[bound[owner[part]] > column]
            h = mix(cell[part] ^ U64((column + 1) * SECOND % 2**64))
            darts = np.searchsorted(_POISSON, (h >> U64(11)).astype(float) * 2.0**-53, side="right")
            for d in range(int(darts.max()) if len(darts) else 0):
                some = np.flatnonzero(darts > d)
                dart = mix(h[some] + U64((d + 1) * 0x632BE59BD9B4E019 % 2**64))
                rank = column + (mix(dart ^ U64(SECOND)) >> U64(11)).astype(float) * 2.0**-53
                height = (mix(dart ^ U64(0xA0761D6478BD642F)) >> U64(11)).astype(float) * 2.0**-53
                who = owner[part[some]]
                ok = (rank < bound[who]) & (height < filled[part[some]])
                found.append((who[ok], (mix(dart ^ U64(0xE7037ED1A0B428DB)) % U64(size)).astype(np.int64)[ok], rank[ok], dart[ok]))
            column += 1
        if found:
            who, place, rank, dart = (np.concatenate(x) for x in zip(*found, strict=True))
            slot = who * size + place
            order = np.lexsort((dart, rank, slot))
            first = order[np.concatenate(([True], np.diff(slot[order]) != 0))] if len(order) else order
            best.reshape(-1)[slot[first]] = rank[first]
            out.reshape(-1)[slot[first]] = dart[first]
        todo = todo[np.isinf(best[todo]).any(axis=1)]
        out[todo] = 0
        bound[todo] *= 2
    return out


def _bag(element: np.ndarray, weight: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """A number for each multiset."""
    return mix(Rolling(element).of(lo, hi) ^ mix(Rolling(mix(element) + weight.astype(U64), SECOND).of(lo, hi))).view(np.int64)


def signed(rows: DataFrame, words: int = WORDS, size: int = SIZE) -> DataFrame:
    """Rows (doc_key, text_key, node, signature); ``node`` tells multisets apart, null where there are no words.

    A signature holds the upper half of each dart's identity.
    """

    def build(batches):
        for part in slices(batches, text_sizes, 1_000_000):
            n = part.num_rows
            element, doc, weight = weigh(*shingles(part.column("text").to_pylist(), words))
            sign = signatures(element, doc, weight, n, size)
            ends = np.searchsorted(doc, np.arange(n + 1))
            empty = ends[1:] == ends[:-1]
            node = pa.array(_bag(element, weight, ends[:-1], ends[1:]), mask=empty)
            sign = (sign >> U64(32)).astype("<u4")
            sign = pa.array([None if e else x.tobytes() for e, x in zip(empty, sign, strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("doc_key"), part.column("text_key"), node, sign], names=["doc_key", "text_key", "node", "signature"])

    return rows.select("doc_key", "text_key", "text").mapInArrow(build, "doc_key long, text_key long, node long, signature binary")


def multisets(rows: DataFrame, words: int = WORDS) -> DataFrame:
    """Rows (node, elements, weights): the multisets themselves; weights are left out where all are 1."""

    def build(batches):
        for part in slices(batches, text_sizes, 1_000_000):
            element, doc, weight = weigh(*shingles(part.column("text").to_pylist(), words))
            ends = np.searchsorted(doc, np.arange(part.num_rows + 1))
            node = _bag(element, weight, ends[:-1], ends[1:])
            bounds = list(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True))
            elements = [element[i:j].tobytes() for i, j in bounds]
            weights = [weight[i:j].astype("<u4").tobytes() if (weight[i:j] != 1).any() else b"" for i, j in bounds]
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(elements, pa.binary()), pa.array(weights, pa.binary())], names=["node", "elements", "weights"])

    return rows.select("text").mapInArrow(build, "node long, elements binary, weights binary")


def jaccard(a: tuple[bytes, bytes], b: tuple[bytes, bytes]) -> float:
    """Weighted Jaccard similarity of two sorted multisets."""
    x, y = np.frombuffer(a[0], U64), np.frombuffer(b[0], U64)
    v = np.frombuffer(a[1], "<u4").astype(float) if a[1] else np.ones(len(x))
    w = np.frombuffer(b[1], "<u4").astype(float) if b[1] else np.ones(len(y))
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    both = np.minimum(v[i], w[j]).sum()
    return float(both / (v.sum() + w.sum() - both))


def _bands(signs: DataFrame, size: int, each: int) -> DataFrame:
    """(node, band): one row for each band of a signature."""
    step = 4 * each
    parts = [F.xxhash64(F.lit(i), F.substring("signature", i * step + 1, step)) for i in range(size // each)]
    return signs.select("node", F.explode(F.array(*parts)).alias("band"))


def sketches(signs: DataFrame) -> DataFrame:
    """(node, sketch): one byte of each coordinate, so that pairs take little room where they are compared."""

    def cut(batches):
        for batch in batches:
            every = [np.frombuffer(x, "<u4").astype(np.uint8).tobytes() for x in batch.column("signature").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(every, pa.binary())], names=["node", "sketch"])

    return signs.select("node", "signature").mapInArrow(cut, "node long, sketch binary")


def _alike(pairs: DataFrame, few: DataFrame, threshold: float, size: int) -> DataFrame:
    """Pairs whose sketches agree at least as often as signatures of that similarity do, within five standard deviations.

    Bytes agree wherever coordinates do, so no pair is lost by them.
    """
    least = size * threshold - 5 * (size * threshold * (1 - threshold)) ** 0.5

    def check(batches):
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, size) for c in ("x", "y"))
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array((x == y).sum(axis=1) >= least))

    x, y = (few.select(F.col("node").alias(n), F.col("sketch").alias(c)) for n, c in (("a", "x"), ("b", "y")))
    return pairs.join(x, "a").join(y, "b").mapInArrow(check, "a long, b long")


def _checked(pairs: DataFrame, bags: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose multisets are at least as similar as ``threshold``."""

    def check(batches):
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("xe", "xw", "ye", "yw")]
            ok = [jaccard((p, q), (r, s)) >= threshold for p, q, r, s in zip(*cols, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    x, y = (bags.select(F.col("node").alias(n), F.col("elements").alias(f"{c}e"), F.col("weights").alias(f"{c}w")) for n, c in (("a", "x"), ("b", "y")))
    return pairs.join(x, "a").join(y, "b").mapInArrow(check, "a long, b long")


def _pivots(members: DataFrame, most: int) -> DataFrame:
    """Up to ``most`` members of each bucket that may be a pivot, those of its smallest components first.

    Of equally small ones the most central comes first: that whose buckets hold most members, as those of a text do from
    which many others were made.
    """
    count = members.groupBy("band", "label").agg(F.count("*").alias("n"))
    open_members = members.where("first").join(count, ["band", "label"])
    order = Window.partitionBy("band").orderBy("n", F.desc("central"), "label", "node")
    first = open_members.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= most)
    return first.select("band", F.col("node").alias("pivot"), F.col("label").alias("pivot_label"), F.col("size").alias("pivot_size"), F.col("behind").alias("pivot_behind"))


def _joined(label: DataFrame, links: DataFrame) -> DataFrame:
    """The labels after the components that the links (a, b) connect are one; only labels that a link joins move."""
    x, y = (label.select(F.col("node").alias(n), F.col("label").alias(c)) for n, c in (("a", "x"), ("b", "y")))
    step = saved(components(links.join(x, "a").join(y, "b").select(F.col("x").alias("a"), F.col("y").alias("b"))), "labels")
    to = step.select(F.col("node").alias("label"), F.col("label").alias("to"))
    moved = saved(label.join(to, "label", "left").select("node", F.coalesce("to", "label").alias("label")), "labels")
    forget(step, label, links)
    return moved


def by_element(nodes: DataFrame, bags: DataFrame, threshold: float) -> DataFrame:
    """Members (band, node, first, central, size, behind) of buckets by element, in which all similar ones of ``nodes`` meet.

    Elements are put in one order for all, those of the fewest nodes first. Two multisets whose smallest common element
    has less than the overlap they need behind it, itself included, cannot be similar. The overlap is at least
    ``threshold`` times the size of either, and ``2 * threshold / (1 + threshold)`` times that of the smaller one, so of two
    similar ones the smaller is a ``first`` member of a bucket that the other is in too. Elements of one node alone come
    before all others and make no bucket: members of a group that each differ from all others in enough places meet nobody.
    """

    def spread(batches):
        for batch in batches:
            for node, central, e, w in zip(*(batch.column(c).to_pylist() for c in ("node", "central", "elements", "weights")), strict=True):
                n = len(e) // 8
                weight = np.frombuffer(w, "<u4").astype(np.int64) if w else np.ones(n, np.int64)
                cols = [np.full(n, node), np.full(n, central), np.frombuffer(e, np.int64), weight, np.full(n, weight.sum())]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["node", "central", "band", "weight", "size"])

    every = saved(nodes.join(bags, "node").mapInArrow(spread, "node long, central long, band long, weight long, size long"), "elements")
    shared = every.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    behind = F.sum("weight").over(Window.partitionBy("node").orderBy(F.desc("n"), F.desc("band")).rowsBetween(Window.unboundedPreceding, 0))
    placed = every.join(shared, "band").withColumn("behind", behind)
    least = threshold * (1 - 1e-9)  # as sizes are whole, more than rounding needs
    placed = placed.where(F.col("behind") >= least * F.col("size")).withColumn("first", F.col("behind") >= 2 * least / (1 + threshold) * F.col("size"))
    # a bucket without first members joins nobody
    members = saved(placed.select("band", "node", "first", "central", "size", "behind"), "bands")
    forget(every)
    return members


def linked(rows: DataFrame, signs: DataFrame, words: int, threshold: float, size: int, each: int) -> DataFrame:
    """(node, label) of the multisets that share a bucket with others, labelled by component of their links."""
    banded = _bands(signs, size, each)
    shared = banded.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    met = saved(banded.join(shared, "band"), "bands")
    central = met.groupBy("node").agg(F.sum("n").alias("central"))
    members = saved(met.join(central, "node").select("band", "node", F.lit(True).alias("first"), "central", *(F.lit(0).cast("long").alias(c) for c in ("size", "behind"))), "bands")
    forget(met)
    label = saved(members.select("node").distinct().select("node", F.col("node").alias("label")), "labels")
    nodes = label.select("node")
    one_row = signs.join(nodes, "node", "left_semi").select("doc_key", "text_key", "node")
    bags = saved(multisets(rows.join(one_row, ["doc_key", "text_key"], "left_semi"), words).dropDuplicates(["node"]), "multisets")
    few = saved(sketches(signs.join(nodes, "node", "left_semi")), "sketches")

    def found(pairs: DataFrame) -> DataFrame:
        pairs = saved(pairs.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct(), "pairs")
        links = saved(_checked(_alike(pairs, few, threshold, size), bags, threshold), "links")
        forget(pairs)
        return links

    # first each node meets the most central member of all its buckets; that joins most of what belongs together
    middle = members.groupBy("band").agg(F.max(F.struct("central", "node")).alias("m"))
    middle = members.join(middle, "band").groupBy("node").agg(F.max("m").alias("m"))
    links, most, past, passes = found(middle.select("node", F.col("m.node").alias("pivot")).where("node <> pivot")), 1, [members], 0

    def unfinished(members: DataFrame) -> DataFrame:
        # done: buckets whose members, none of them a pivot so far, are in one component or may be no pivot
        now = members.join(label, "node")
        ends = now.groupBy("band").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.max("first").alias("more"))
        return saved(now.join(ends.where("x < y and more").select("band"), "band", "left_semi"), "bands")

    while True:
        label = _joined(label, links)
        left, passes = unfinished(members), passes + 1
        forget(*past)
        if passes == BAND_PASSES and not left.isEmpty():
            # what has not met by now shares a bucket here: elements tell unlike members apart, bands do not
            members, most = by_element(left.select("node", "central").distinct(), bags, threshold), 1
            forget(left)
            left = unfinished(members)
            forget(members)
        if left.isEmpty():
            forget(left, bags, few)
            return label
        pivots = saved(_pivots(left, most), "pivots")
        # of a bucket by element: what lies behind it must do for the overlap, or the two meet at a smaller element or not at all
        enough = F.least("behind", "pivot_behind") >= (1 - 1e-9) * threshold / (1 + threshold) * (F.col("size") + F.col("pivot_size"))
        links = found(left.join(pivots, "band").where(F.col("label") != F.col("pivot_label")).where(enough))
        was = pivots.select("band", F.col("pivot").alias("node"))  # a pivot has met all others, so it leaves the bucket
        members = left.drop("label").join(was, ["band", "node"], "left_anti")
        past = [left, pivots]
        most *= 4


def classes(docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD, size: int = SIZE, rows: int = ROWS) -> DataFrame:
    """Rows (doc_key, text_key, class_id): one for each distinct row that has words."""
    base = keyed(docs)
    every = saved(signed(base, words, size), "signatures")
    signs = every.where("node is not null")
    one = signs.groupBy("node").agg(F.min(F.struct("doc_key", "text_key", "signature")).alias("r")).select("node", "r.*")
    one, rows_of = saved(one, "nodes"), saved(signs.select("doc_key", "text_key", "node").distinct(), "rows")
    forget(every)
    label = linked(base, one, words, threshold, size, rows)
    forget(one)
    labelled = rows_of.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = labelled.groupBy("label").agg(F.min(F.struct("doc_key", "text_key")).alias("least"))
    return labelled.join(least, "label").select("doc_key", "text_key", F.col("least.doc_key").alias("class_id"), F.col("least.text_key").alias("class_text"))


def near_duplicates(docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD, size: int = SIZE, rows: int = ROWS) -> DataFrame:
    """Per document: ``class_id``, the least id of its class, and ``kept``: whether it is the one that names it."""
    found = classes(docs, words, threshold, size, rows)
    out = keyed(docs).select("doc_id", "doc_key", "text_key").join(found, ["doc_key", "text_key"], "left")
    alone = F.col("doc_id").isNull() | F.col("class_id").isNull()
    first = (F.col("doc_key") == F.col("class_id")) & (F.col("text_key") == F.col("class_text"))
    return out.select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.when(alone, True).otherwise(first).alias("kept"))


def keep_first(docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD, size: int = SIZE, rows: int = ROWS) -> DataFrame:
    """The documents without near-duplicates: of each class the row that names it, and every row without words.

    Of rows that are equal in id and text one stays, if they have words. All columns are kept.
    """
    found = classes(docs, words, threshold, size, rows).select(F.col("doc_key").alias("__doc"), F.col("text_key").alias("__text"), "class_id", "class_text")
    first = (F.col("__doc") == F.col("class_id")) & (F.col("__text") == F.col("class_text"))
    found = found.select("__doc", "__text", first.alias("__first"))
    rows_in = docs.withColumns({"__doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(MAX_LONG)), "__text": F.xxhash64(F.coalesce("text", F.lit("")))})
    joined = rows_in.join(found, ["__doc", "__text"], "left")
    nth = F.row_number().over(Window.partitionBy("__doc", "__text").orderBy(F.lit(0)))
    kept = joined.withColumn("__nth", nth).where("__first is null or doc_id is null or (__first and __nth = 1)")
    return kept.select(*docs.columns)
