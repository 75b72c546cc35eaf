"""BPE encoding and decoding of whole texts by tree concatenation.

Long texts are cut into chunks of ``chunk_chars`` code points, wherever that falls. Chunks are rows of their own, so
the parts of one text are encoded in parallel; a tree of joins then puts neighbours together. At a join a window
around it is encoded anew, and grows twofold until both sides agree with it: left of the join, and right of it, there
is a token that the half and the window have at the same place. The pair of tokens at each seam then stands in the
window's own encoding. A sequence in which every neighbouring pair is one that BPE itself produces is the encoding, so
runs without a single space are right too. Between matches of the split pattern the seam must be a surely split place
(a character that is no white space, then a space), as a window cannot see how a match began. If no window agrees, it
reaches the ends of both halves, which is encoding them whole.

Nulls are empty texts (0 ids); repeated rows and null ids are kept as rows; other columns are left behind.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import byte_bpe
from .common import documents, keyed

_SURE = re.compile(r"(?<=\S) (?=\S)")


class Half:
    """A text with its ids and the byte offsets of its tokens."""

    def __init__(self, coder, text: str, ids: bytes | None = None):
        self.text, self.raw = text, text.encode()
        self.ids = np.frombuffer(coder.encode(text) if ids is None else ids, "<u4")
        self.ends = np.cumsum(coder.lengths[self.ids])


def _sure_places(text: str) -> np.ndarray:
    """Byte offsets at which the split pattern surely splits."""
    raw, places = text.encode(), []
    for m in _SURE.finditer(text):
        places.append(len(text[: m.start()].encode()) if not text.isascii() else m.start())
    return np.array(places, np.int64) if raw else np.zeros(0, np.int64)


def _one_run(text: str) -> bool:
    """One match of the split pattern: letters only."""
    return text.isalpha()


def join(coder, left: Half, right: Half, window: int = 64) -> Half:
    """The encoding of ``left.text + right.text``."""
    text = left.text + right.text
    cut = len(left.raw)
    while True:
        a, b = max(0, len(left.text) - window), min(len(right.text), window)
        whole = a == 0 and b == len(right.text)
        middle = Half(coder, left.text[a:] + right.text[:b])
        if whole:
            return middle
        base = len(left.text[:a].encode())
        seams = _seams(left, right, middle, base, cut, a == 0, b == len(right.text))
        if seams is not None:
            lo, hi = seams
            n, m, k, r = (np.searchsorted(e, at, side="right") for e, at in ((left.ends, lo), (middle.ends, lo - base), (middle.ends, hi - base), (right.ends, hi - cut)))
            return Half(coder, text, np.concatenate([left.ids[:n], middle.ids[m:k], right.ids[r:]]).astype("<u4").tobytes())
        window *= 2


def _seams(left, right, middle, base, cut, at_start, at_end):
    """Byte offsets in the joined text at which left and window, and window and right, may be put together."""
    ends = middle.ends + base
    if _one_run(middle.text):
        # a token that both have with the same start and end; the seam is its end (left) or its start (right)
        mine = set(zip((ends - _lengths(middle)).tolist(), ends.tolist(), strict=True))
        lo = base if at_start else next((e for s, e in reversed(_spans(left, 0)) if e <= cut and (s, e) in mine and s > base), None)
        hi = ends[-1] if at_end else next((s for s, e in _spans(right, cut) if s >= cut and (s, e) in mine and e < ends[-1]), None)
        if lo is None or hi is None or hi < lo:
            return None
        return lo, int(hi)
    sure = _sure_places(middle.text) + base
    both_left = sure[np.isin(sure, left.ends) & np.isin(sure, ends) & (sure < cut)]
    both_right = sure[np.isin(sure, right.ends + cut) & np.isin(sure, ends) & (sure > cut)]
    lo = base if at_start else (int(both_left[-1]) if len(both_left) else None)
    hi = int(ends[-1]) if at_end else (int(both_right[0]) if len(both_right) else None)
    return None if lo is None or hi is None else (lo, hi)


def _lengths(half) -> np.ndarray:
    return np.diff(np.concatenate(([0], half.ends)))


def _spans(half, base: int) -> list[tuple[int, int]]:
    ends = half.ends + base
    return list(zip((ends - _lengths(half)).tolist(), ends.tolist(), strict=True))


def tree(coder, halves: list[Half]) -> Half:
    """Join neighbours, level by level."""
    while len(halves) > 1:
        pairs = [halves[i : i + 2] for i in range(0, len(halves), 2)]
        halves = [join(coder, *p) if len(p) == 2 else p[0] for p in pairs]
    return halves[0]


def _chunks(chunk_chars: int):
    n = F.ceil(F.length("text") / F.lit(chunk_chars)).cast("int")
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(i.alias("part"), F.substring("text", i * chunk_chars + 1, F.lit(chunk_chars)).alias("chunk")))


def encode(docs: DataFrame, chunk_chars: int = 16_384, tokenizer: str = "byte_bpe_50k.tiktoken", finish=None, schema: str = "doc_id long, ids binary, text string") -> DataFrame:
    """Ids of every whole text, with its text as decoded from them.

    ``ids`` holds little-endian unsigned 32-bit numbers. ``finish(doc_id, ids, coder)`` may return other columns for
    ``schema`` in their place, so that a digest needs no second pass.
    """
    finish = finish or (lambda doc_id, ids, coder: (doc_id, ids, coder.decode(np.frombuffer(ids, "<u4"))))
    names = _arrow(schema)

    def table_of(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(names)], schema=names)

    def short(batches):
        coder = byte_bpe.load(tokenizer)
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                yield table_of([finish(d, coder.encode(t), coder) for d, t in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True)])

    def part_ids(batches):
        coder = byte_bpe.load(tokenizer)
        for batch in batches:
            for lo in range(0, batch.num_rows, 100):
                part = batch.slice(lo, 100)
                ids = pa.array([coder.encode(t) for t in part.column("chunk").to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, ids], names=[*part.schema.names, "ids"])

    def joined(key, frame):
        coder = byte_bpe.load(tokenizer)
        parts = sorted(zip(*(frame.column(c).to_pylist() for c in ("part", "chunk", "ids")), strict=True), key=lambda r: r[0])
        whole = tree(coder, [Half(coder, chunk, ids) for _, chunk, ids in parts])
        row = finish(frame.column("doc_id")[0].as_py(), whole.ids.tobytes(), coder)
        return pa.Table.from_batches([table_of([row] * key[2].as_py())])

    base = documents(docs)
    direct = base.where(F.length("text") <= chunk_chars).mapInArrow(short, schema)
    long = keyed(base).where(F.length("text") > chunk_chars)
    # equal rows are one group, which counts them and never mixes their chunks
    long = long.groupBy("doc_id", "doc_key", "text_key", "text").agg(F.count("*").cast("int").alias("copies"))
    parts = long.select("doc_id", "doc_key", "text_key", "copies", F.inline(_chunks(chunk_chars)))
    parts = parts.repartition(F.col("doc_key"), F.col("part"))
    coded = parts.mapInArrow(part_ids, "doc_id long, doc_key long, text_key long, copies int, part int, chunk string, ids binary")
    return direct.unionByName(coded.groupBy("doc_key", "text_key", "copies").applyInArrow(joined, schema))


_ARROW = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "int": pa.int32()}


def _arrow(schema: str) -> pa.Schema:
    return pa.schema([(n, _ARROW[t]) for n, t in (x.split() for x in schema.split(","))])


def digest(docs: DataFrame) -> DataFrame:
    """Per document: number of ids, hash of the ids, hash of the text decoded from them."""

    def finish(doc_id, ids, coder):
        numbers = np.frombuffer(ids, "<u4")
        return doc_id, len(numbers), hashlib.sha256(ids).hexdigest(), hashlib.sha256(coder.decode(numbers).encode()).hexdigest()

    return encode(docs, finish=finish, schema="doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
