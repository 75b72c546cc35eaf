"""Quality of documents by a convolutional network over bytes, written in numpy.

A text is read as UTF-8 bytes, cut into chunks of ``CHUNK`` bytes that overlap by ``OVERLAP``, so that together they cover
the whole document whatever its length. Bytes become learned vectors, learned filters slide over every position of a
chunk, and a filter's largest response in the chunk is kept. A dense layer turns the responses into evidence of the chunk;
the largest and the mean evidence of a document's chunks are combined into one probability.

The network is fitted on the driver by back-propagation (a largest response passes its slope on to one window only), on at
most ``sample_rows`` labelled documents of each class that are no longer than ``sample_bytes``, chosen by a hash: so the
sample takes at most ``2 * sample_rows * sample_bytes`` bytes there, and is the only part that does not see all rows.
Documents of a class count by how many of them there are in all training labels, so probabilities keep the true ratio of
the classes at every size of table. Scoring sees every byte of every document in blocks of bounded memory, one map over
the table without a shuffle.

Null texts are empty; an empty text is one chunk of padding. Equal texts score alike. Without labelled rows of both classes
the score is the share of label 1 among the labels there are, or 0. Labels that are null or neither 0 nor 1 teach nothing;
where labels of an id differ, the largest holds.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, release, slices, text_sizes

#: Labelled documents of each class that the network is fitted on, at most, and the bytes of the longest of them.
SAMPLE_ROWS, SAMPLE_BYTES = 1_000, 16_384
CHUNK, OVERLAP, WIDTH = 512, 64, 6
FILTERS, DEPTH, HIDDEN = 32, 8, 16
PASSES, BATCH, RATE = 10, 32, 4e-3
KEEP = 0.3
PAD = 256
#: Chunks that are computed at a time.
BLOCK = 64


def chunks(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The chunks of all texts as rows of byte numbers, and how many each text has."""
    hop = CHUNK - OVERLAP
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    count = np.maximum(-(-(sizes - OVERLAP) // hop), 1)
    rows = np.full((int(count.sum()), CHUNK), PAD, np.int16)
    at = 0
    for text, n in zip(texts, count.tolist(), strict=True):
        data = np.full((n - 1) * hop + CHUNK, PAD, np.int16)
        data[: len(text)] = np.frombuffer(text, np.uint8)
        rows[at : at + n] = np.lib.stride_tricks.sliding_window_view(data, CHUNK)[::hop]
        at += n
    return rows, count


@dataclass
class Network:
    """Weights: bytes, filters, chunk evidence, and the two pooled parts of the document with their bias."""

    weights: dict[str, np.ndarray]
    constant: float | None = None

    @classmethod
    def fresh(cls, seed: int = 5) -> Network:
        r = np.random.default_rng(seed)
        make = lambda *shape, by: (r.standard_normal(shape) * by).astype(np.float32)
        w = {
            "bytes": make(PAD + 1, DEPTH, by=0.5), "filters": make(WIDTH * DEPTH, FILTERS, by=(WIDTH * DEPTH) ** -0.5), "lift": np.zeros(FILTERS, np.float32),
            "dense": make(FILTERS, HIDDEN, by=FILTERS**-0.5), "raise": np.full(HIDDEN, 0.1, np.float32), "out": make(2 * HIDDEN, by=HIDDEN**-0.5), "bias": np.zeros(1, np.float32),
        }
        w["bytes"][PAD] = 0
        return cls(w)

    def pooled(self, rows: np.ndarray, places: bool = False):
        """The largest response of each filter in each chunk, and where it is."""
        w, spots = self.weights, CHUNK - WIDTH + 1
        top, at = np.empty((len(rows), FILTERS), np.float32), np.empty((len(rows), FILTERS), np.int64) if places else None
        for lo in range(0, len(rows), BLOCK):
            seen = w["bytes"][rows[lo : lo + BLOCK]].reshape(-1, CHUNK * DEPTH)
            windows = np.lib.stride_tricks.sliding_window_view(seen, WIDTH * DEPTH, axis=1)[:, ::DEPTH]
            response = (np.ascontiguousarray(windows).reshape(-1, WIDTH * DEPTH) @ w["filters"]).reshape(-1, spots, FILTERS)
            if places:
                at[lo : lo + BLOCK] = response.argmax(axis=1)
            top[lo : lo + BLOCK] = response.max(axis=1)
        return (top + w["lift"], at) if places else top + w["lift"]

    def __call__(self, texts: list[bytes]) -> np.ndarray:
        """The probability of label 1 for each text; chunks of many texts are computed together."""
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        w, out = self.weights, np.empty(len(texts))
        for lo, hi in _groups(texts):
            evidence, count = [], []
            for part in _pieces(texts[lo:hi]):
                rows, n = chunks(part) if isinstance(part, list) else (part, None)
                evidence.append(np.maximum(np.maximum(self.pooled(rows), 0) @ w["dense"] + w["raise"], 0))
                count.append(n)
            found, sizes = np.concatenate(evidence), count[0] if count[0] is not None else np.array([sum(map(len, evidence))])
            begin = np.cumsum(sizes) - sizes
            both = np.hstack([np.maximum.reduceat(found, begin), np.add.reduceat(found, begin) / sizes[:, None]])
            out[lo:hi] = 1 / (1 + np.exp(-np.clip((both @ w["out"] + w["bias"]).astype(float), -30, 30)))
        return out


#: Bytes whose chunks are held at once.
HELD = 1 << 20


def _groups(texts: list[bytes]):
    """Ranges of texts of about ``HELD`` bytes together, a longer text on its own."""
    lo, size = 0, 0
    for i, text in enumerate(texts):
        if i > lo and size + len(text) > HELD:
            yield lo, i
            lo, size = i, 0
        size += len(text) + CHUNK
    if len(texts) > lo:
        yield lo, len(texts)


def _pieces(texts: list[bytes]):
    """The texts at once, or the chunks of one very long text a bounded number at a time."""
    if len(texts) > 1 or len(texts[0]) <= HELD:
        yield texts
        return
    text, hop = texts[0], CHUNK - OVERLAP
    step = HELD // hop * hop
    at = 0
    while len(text) - at > step + OVERLAP:
        yield chunks([text[at : at + step + OVERLAP]])[0]
        at += step
    yield chunks([text[at:]])[0]


def _slopes(net: Network, texts: list[bytes], y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    """Slopes of the weighted log loss of one batch."""
    w = net.weights
    rows, count = chunks(texts)
    top, at = net.pooled(rows, places=True)
    top = np.maximum(top, 0)
    evidence = np.maximum(top @ w["dense"] + w["raise"], 0)
    owner = np.repeat(np.arange(len(texts)), count)
    begin = np.cumsum(count) - count
    most, mean = np.maximum.reduceat(evidence, begin), np.add.reduceat(evidence, begin) / count[:, None]
    both = np.hstack([most, mean])
    p = 1 / (1 + np.exp(-np.clip(both @ w["out"] + w["bias"], -30, 30)))
    off = ((p - y) * weight / weight.sum()).astype(np.float32)
    slope = {"out": both.T @ off, "bias": np.array([off.sum()], np.float32)}
    back = off[:, None] * w["out"]
    # the first chunk with the largest evidence takes the slope of the maximum
    equal = evidence == most[owner]
    earlier = np.cumsum(equal, axis=0) - equal
    first = equal & (earlier == earlier[begin][owner])
    down = (first * back[owner, :HIDDEN] + (back[:, HIDDEN:] / count[:, None])[owner]) * (evidence > 0)
    slope["dense"], slope["raise"] = top.T @ down, down.sum(axis=0)
    down = (down @ w["dense"].T) * (top > 0)
    slope["lift"] = down.sum(axis=0)
    window = rows[np.arange(len(rows))[:, None, None], at[:, :, None] + np.arange(WIDTH)]
    seen = w["bytes"][window]
    slope["filters"] = np.einsum("nf,nfkd->kdf", down, seen, optimize=True).reshape(-1, FILTERS)
    into = down[:, :, None, None] * w["filters"].T.reshape(1, FILTERS, WIDTH, DEPTH)
    flat = window.ravel()
    slope["bytes"] = np.stack([np.bincount(flat, into[..., k].ravel(), PAD + 1) for k in range(DEPTH)], axis=1)
    slope["bytes"][PAD] = 0
    return slope


def fit(texts: list[bytes], y: np.ndarray, weight: np.ndarray | None = None, passes: int = PASSES, seed: int = 5) -> Network:
    """Steps by slopes that are scaled with their running mean and size; a fixed seed gives the order of the texts."""
    weight = np.ones(len(y)) if weight is None else weight
    net = Network.fresh(seed)
    if not len(y) or y.min() == y.max():
        net.constant = float(y.mean()) if len(y) else 0.0
        return net
    mean, size = ({k: np.zeros_like(v) for k, v in net.weights.items()} for _ in range(2))
    net.weights["bias"][:] = np.log((weight @ y) / (weight @ (1 - y)))
    order, step = np.random.default_rng(seed), 0
    steps = passes * -(-len(y) // BATCH)
    for _ in range(passes):
        for part in np.array_split(order.permutation(len(y)), -(-len(y) // BATCH)):
            slope = _slopes(net, [texts[i] for i in part], y[part], weight[part])
            step += 1
            rate = RATE * min(1.0, step / 20) * (1 - step / (steps + 1))
            for k, g in slope.items():
                mean[k] = 0.9 * mean[k] + 0.1 * g
                size[k] = 0.99 * size[k] + 0.01 * g * g
                net.weights[k] -= (rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(size[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def held_out(column: str):
    return F.crc32(F.col(column).cast("string")) % 5 == 0


def training_rows(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """(doc_id, text, quality, total): the sample, and how many labelled documents of its class there are."""
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    marked = marked.where("doc_id is not null and quality in (0, 1)").where(~held_out("doc_id"))
    marked = marked.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    texts = documents(docs).withColumn("text_key", F.xxhash64("text"))
    known = texts.select("doc_id", "text_key", F.octet_length("text").alias("size")).join(marked, "doc_id").distinct()
    total = {r.quality: r["count"] for r in known.groupBy("quality").count().collect()}
    chosen = None
    for y in sorted(total):
        few = known.where((F.col("quality") == y) & (F.col("size") <= sample_bytes)).orderBy(F.xxhash64("doc_id", "text_key"), "doc_id", "text_key").limit(sample_rows)
        few = few.select("doc_id", "text_key", "quality", F.lit(total[y]).alias("total"))
        chosen = few if chosen is None else chosen.unionByName(few)
    if chosen is None:
        return texts.select("doc_id", "text", F.lit(0).alias("quality"), F.lit(0).alias("total")).limit(0)
    # one row for each chosen id and text: at most twice sample_rows
    found = texts.join(F.broadcast(chosen), ["doc_id", "text_key"]).groupBy("doc_id", "text_key", "quality", "total").agg(F.first("text").alias("text"))
    return found.select("doc_id", "text", "quality", "total")


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES) -> Network:
    rows = sorted(((r.doc_id, r.text, r.quality, r.total) for r in training_rows(docs, labels, sample_rows, sample_bytes).collect()), key=lambda r: r[:2])
    y = np.array([r[2] for r in rows], np.int64)
    weight = np.array([r[3] for r in rows], float) / np.bincount(y, minlength=2)[y]
    return fit([r[1].encode() for r in rows], y, weight)


def score(docs: DataFrame, net: Network) -> DataFrame:
    """(doc_id, score, predicted) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def scored(batches):
        for part in slices(batches, text_sizes, 4_000_000):
            values = shared.value([t.encode() for t in part.column("text").to_pylist()])
            out = [part.column("doc_id"), pa.array(values, pa.float64()), pa.array((values >= KEEP).astype(np.int32), pa.int32())]
            yield pa.RecordBatch.from_arrays(out, names=["doc_id", "score", "predicted"])
        release()

    return documents(docs).mapInArrow(scored, "doc_id long, score double, predicted int")


def quality(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document; the network learns from rows that are not held out."""
    found = score(docs, learn(docs, labels, sample_rows, sample_bytes))
    return found.select("doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "score", "predicted")
