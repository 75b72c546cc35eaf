"""Token counts by a map-side lookup in two tiers.

A pre-token is a run of spaces with the word behind it, or the start of a line with its first word: no entry of the
vocabulary runs from another character into a space, or holds a line feed, so the pieces of a text are those of its
pre-tokens put together. Each task counts its pre-tokens and offers its most frequent ones; a small aggregate picks the
``table_size`` most frequent of those offered, a bound that does not depend on the data, and their lengths go to all
workers. Other pre-tokens are encoded where they are met and kept in a bounded cache of the worker. No pre-token is
shuffled but the offers.

Null texts are empty (0 tokens, 0 bytes). Repeated rows, null ids and very long texts are counted like any other.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents

SPACE = "▁"
MODEL = "piece_bpe_32k.model"
#: Pre-tokens in the broadcast table, and offered by one task; words longer than this many characters are not offered.
TABLE_SIZE, OFFERED, OFFERED_CHARS = 20_000, 4_000, 32
CACHE_SIZE = 300_000
#: Words counted before a task forgets those it met once; bounds the counter.
COUNTED = 500_000
_UNIT = re.compile(r" *[^ ]+| +")
_models: dict[str, Lengths] = {}


class _Cache(dict):
    def __init__(self, measure, table: dict[str, int]):
        self.measure, self.table = measure, table

    def __missing__(self, word: str) -> int:
        n = self.table.get(word)
        if n is None:
            n = self.measure(word)
            if len(self) >= CACHE_SIZE:
                self.clear()
        if len(word) < 64:
            self[word] = n
        return n


class Lengths:
    """Number of pieces of texts, from those of their pre-tokens."""

    def __init__(self, name: str):
        import public_tokenizers as public
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=public.path(name))
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size()) if not self.model.is_byte(i)]
        crossing = [p for p in pieces if re.search(f"[^{SPACE}]{SPACE}", p) or "\n" in p]
        if crossing or self.model.encode("a  b ", out_type=str)[-1] != SPACE:
            raise ValueError(f"{name} has pieces that cross pre-tokens, or drops spaces")
        self.use({})

    def use(self, table: dict[str, int]) -> None:
        """``table``: lengths of the most frequent words that follow a space."""
        self.after_space = _Cache(lambda w: len(self.model.encode(w)) if w else 1, table)
        # the model puts a space before a text; behind a line feed there is none
        self.at_start = _Cache(lambda w: len(self.model.encode("\n" + w)) - 2 if w else 0, {})

    def _line(self, line: str, spaced: bool) -> int:
        if "  " not in line and not line.startswith(" ") and not line.endswith(" "):
            head, *rest = line.split(" ")
            return (self.after_space[head] if spaced else self.at_start[head]) + sum(map(self.after_space.__getitem__, rest))
        units = _UNIT.findall(" " + line if spaced else line)
        n = 0
        for k, unit in enumerate(units):
            if unit[0] != " ":
                n += self.at_start[unit]
            elif unit[1:2] != " ":
                n += self.after_space[unit[1:]]
            else:  # the model adds the first space
                n += len(self.model.encode(unit[1:]))
        return n

    def count(self, text: str) -> int:
        if not text:
            return 0
        head, *lines = text.replace(SPACE, " ").split("\n")
        return (self._line(head, True) if head else 1) + sum(self._line(x, False) for x in lines if x) + len(lines)


def load(name: str = MODEL) -> Lengths:
    if name not in _models:
        _models[name] = Lengths(name)
    return _models[name]


def frequent(docs: DataFrame, table_size: int = TABLE_SIZE, offered: int = OFFERED) -> list[str]:
    """The most frequent of the words that tasks offer: at most ``table_size`` of at most 32 characters."""

    def offers(batches):
        seen: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                seen.update(text.split(" "))
                if len(seen) > COUNTED:
                    seen = Counter(dict(seen.most_common(COUNTED // 4)))
        top = [(w, n) for w, n in seen.most_common(2 * offered) if n > 1 and w and len(w) <= OFFERED_CHARS and "\n" not in w and SPACE not in w][:offered]
        yield pa.RecordBatch.from_pydict({"word": pa.array([w for w, _ in top], pa.string()), "n": pa.array([n for _, n in top], pa.int64())})

    told = documents(docs).select("text").mapInArrow(offers, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return [r.word for r in told.orderBy(F.desc("n"), "word").limit(table_size).collect()]


def token_counts(docs: DataFrame, model: str = MODEL, limit: int = 4096, table_size: int = TABLE_SIZE) -> DataFrame:
    """Per document: bytes, tokens and whether there are more than ``limit``."""
    spark = docs.sparkSession
    words = frequent(docs, table_size)
    coder = load(model)
    table = spark.sparkContext.broadcast(dict(zip(words, map(len, coder.model.encode(words, num_threads=1)), strict=True)))

    def counted(batches):
        lengths = load(model)
        lengths.use(table.value)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            n = [lengths.count(t) for t in texts]
            out = [batch.column("doc_id"), batch.column("n_bytes"), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())]
            yield pa.RecordBatch.from_arrays(out, names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    base = documents(docs).select("doc_id", "text", F.octet_length("text").cast("long").alias("n_bytes"))
    return base.mapInArrow(counted, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
