"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Tokens are lower-cased words without surrounding punctuation; labels of documents become labels of tokens by their
evidence: a token is toxic in a toxic document if it, or a start of it, is found in toxic training documents far more
often than chance. The field has two states, weights for features of the token (the word, its starts and ends, its
shape) and for transitions, and is fitted by maximum likelihood with exact forward-backward gradients on the driver, on
at most ``sample_rows`` labelled rows of each class that are no longer than ``sample_bytes``, chosen by a hash; that is the
only part that does not see all rows. The curve below weighs them by the size of their class among all training labels.
Scoring goes over whole texts: forward-backward gives each token's marginal, the marginals give three sums per document,
and a logistic curve fitted on the same sample turns them into a score. Spans join neighbouring tokens whose marginal is
at least one half, as code point offsets.

Null texts are empty and score like any text without evidence. Repeated rows score alike. Without labelled rows of both
classes nothing is learned: scores are the share of toxic labels, or 0.
"""

from __future__ import annotations

import re
from array import array
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, slices, text_sizes

#: Labelled rows of each class that the model is fitted on, at most.
SAMPLE_ROWS = 1_200
#: Bytes of the longest of them: the sample takes at most ``2 * SAMPLE_ROWS * SAMPLE_BYTES`` bytes on the driver.
SAMPLE_BYTES = 16_384
ROUNDS = 20
#: A token labels toxic documents if it is in so many of them, and in such a share of them, and in a share of them so many
#: times the share of the others.
LEAST, LEAST_SHARE, RATIO = 4, 0.01, 16.0
STARTS, ENDS = (3, 4, 5, 6), (3, 4)
_EDGE = ".,;:!?\"'()[]{}<>|*_-"
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
CACHE_SIZE = 200_000


def features(token: str) -> list[str]:
    """The word, its starts and ends, and its shape."""
    out = [f"w={token}", f"s={'d' if any(c.isdigit() for c in token) else 'a' if token.isalpha() else 'o'}"]
    out += [f"p={token[:n]}" for n in STARTS if len(token) >= n]
    return out + [f"e={token[-n:]}" for n in ENDS if len(token) > n]


def plain(word: str) -> str:
    return word.strip(_EDGE)


def words(text: str) -> list[str]:
    return [plain(w) for w in _TOKEN.findall(text.lower())]


@dataclass
class Model:
    """Weights of the toxic state against the other, transitions between the two, and the curve over documents."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -8.0
    transition: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    curve: tuple[float, ...] = (0.0, 0.0, 0.0, 0.0)

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.curve[0] + evidence @ np.array(self.curve[1:]), -30, 30)))

    def emission(self, token: str) -> float:
        return self.bias + sum(self.weights.get(f, 0.0) for f in features(token))


def marginals(emissions: np.ndarray, lengths: np.ndarray, transition: np.ndarray, pairs: bool = False, block: int = 128):
    """Marginal of the toxic state for every token of chains that lie one after another in ``emissions``.

    Chains are cut into blocks. The blocks run side by side, first to find how each one carries the two states from its
    start to its end, then, when the states between blocks are known, forward and backward; that is exact, and a very
    long text costs no more than many short ones. With ``pairs`` the expected number of each transition is returned too.
    """
    count = -(-lengths // block)
    chain = np.repeat(np.arange(len(lengths)), count)
    at_block = np.cumsum(count) - count
    nth = np.arange(len(chain)) - at_block[chain]
    first = (np.cumsum(lengths) - lengths)[chain] + nth * block
    size = np.minimum(lengths[chain] - nth * block, block)
    order = np.argsort(-size, kind="stable")
    steps = int(size.max()) if len(size) else 0
    alive = np.searchsorted(-size[order], -np.arange(1, steps + 1), side="right")
    trans = np.exp(transition)
    opening = (nth == 0)[order]
    potential = np.stack([np.ones_like(emissions), np.exp(np.clip(emissions, -30, 30))], axis=1)

    def scaled(x):
        return x / x.sum(axis=tuple(range(1, x.ndim)), keepdims=True)

    carry = np.tile(np.eye(2), (len(size), 1, 1))
    for t in range(steps):
        n = alive[t]
        moved = (carry[:n].reshape(-1, 2) @ trans).reshape(-1, 2, 2)
        now = moved if t else np.where(opening[:n, None, None], carry[:n], moved)
        carry[:n] = scaled(now * potential[first[order[:n]] + t][:, None, :])
    over = np.empty_like(carry)
    over[order] = carry
    enter, leave = np.ones((len(size), 2)), np.ones((len(size), 2))
    for k in range(1, int(count.max()) if len(count) else 0):
        b = at_block[count > k] + k
        enter[b] = scaled(np.einsum("ni,nij->nj", enter[b - 1], over[b - 1]))
    for k in range(int(count.max()) - 2 if len(count) else -1, -1, -1):
        b = at_block[count > k + 1] + k
        leave[b] = scaled(np.einsum("nij,nj->ni", over[b + 1], leave[b + 1]))
    forward = np.empty((len(emissions), 2))
    state = enter[order]
    for t in range(steps):
        n = alive[t]
        at = first[order[:n]] + t
        moved = state[:n] @ trans
        state = scaled((moved if t else np.where(opening[:n, None], state[:n], moved)) * potential[at])
        forward[at] = state
    out = np.empty(len(emissions))
    expected = np.zeros((2, 2))
    back = leave[order]
    for t in range(steps - 1, -1, -1):
        n = alive[t]
        at = first[order[:n]] + t
        both = forward[at] * back[:n]
        out[at] = both[:, 1] / both.sum(axis=1)
        ahead = potential[at] * back[:n]
        if pairs:
            inner = slice(None) if t else ~opening[:n]
            joint = forward[at[inner] - 1][:, :, None] * trans * ahead[inner][:, None, :]
            expected += scaled(joint).sum(axis=0)
        back[:n] = scaled(ahead @ trans.T)
    return (out, expected) if pairs else out


@dataclass
class Corpus:
    """The tokens of some documents as numbers of distinct words, and the features of these words.

    Word ``i`` has feature ``cols[j]`` for every ``j`` with ``rows[j] == i``; the rows are in order.
    """

    flat: np.ndarray
    lengths: np.ndarray
    names: list[str]
    rows: np.ndarray
    cols: np.ndarray
    n_words: int

    @classmethod
    def of(cls, texts: list[str]) -> Corpus:
        """Texts become numbers one by one; only distinct words and features are kept as strings."""
        ids: dict[str, int] = {}
        parts = [np.fromiter((ids.setdefault(w, len(ids)) for w in words(t)), np.int32) for t in texts]
        lengths = np.array([len(p) for p in parts], np.int64)
        flat = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        del parts
        names: dict[str, int] = {}
        count, cols = np.zeros(len(ids), np.int64), array("i")
        for n, word in enumerate(ids):
            found = features(word)
            count[n] = len(found)
            cols.extend(names.setdefault(f, len(names)) for f in found)
        rows = np.repeat(np.arange(len(ids), dtype=np.int32), count)
        return cls(flat, lengths, list(names), rows, np.frombuffer(cols, np.int32) if len(cols) else np.zeros(0, np.int32), len(ids))


def token_labels(corpus: Corpus, toxic: np.ndarray, chosen: np.ndarray, least: int = LEAST, ratio: float = RATIO) -> np.ndarray:
    """Label the tokens of the chosen toxic documents whose word or start is found mostly in toxic ones."""
    n = np.maximum(np.bincount(toxic[chosen], minlength=2), 1)
    listed = np.array([f[0] in "wp" for f in corpus.names], bool)
    rows, cols = corpus.rows[listed[corpus.cols]], corpus.cols[listed[corpus.cols]]
    begin = np.searchsorted(rows, np.arange(corpus.n_words + 1))
    first = np.cumsum(corpus.lengths) - corpus.lengths
    seen = np.zeros((2, len(listed)), np.int64)
    for d in np.flatnonzero(chosen).tolist():
        # the features of a document once each
        word = np.unique(corpus.flat[first[d] : first[d] + corpus.lengths[d]])
        size = begin[word + 1] - begin[word]
        place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begin[word], size)
        seen[int(toxic[d]), np.unique(cols[place])] += 1
    strong = listed & (seen[1] >= max(least, LEAST_SHARE * n[1])) & (seen[1] / n[1] > ratio * (seen[0] + 0.5) / n[0])
    verdict = np.bincount(rows, strong[cols], corpus.n_words) > 0
    flat, lengths = _tokens(corpus, chosen)
    return verdict[flat] & np.repeat(toxic[chosen] == 1, lengths)


def fit(texts: list[str], toxic: np.ndarray, weight: np.ndarray | None = None, rounds: int = ROUNDS) -> Model:
    """Maximum likelihood with a quadratic penalty; steps are scaled by what each weight has moved so far.

    ``weight`` tells how many documents a text stands for: the curve over documents, and with it the threshold, keeps the
    ratio of the classes that all labels have, whatever share of each class is in the sample.
    """
    model = Model()
    if not len(toxic) or toxic.min() == toxic.max():
        share = float(toxic.mean()) if len(toxic) else 0.0  # one class at most
        model.curve = (float(np.log((share + 1e-6) / (1 - share + 1e-6))), 0.0, 0.0, 0.0)
        return model
    corpus = Corpus.of(texts)
    weight = np.ones(len(toxic)) if weight is None else weight
    # the curve must know what a text that the field has not seen looks like, so each half is read by a field of the other
    half = np.arange(len(toxic)) % 2
    seen = np.zeros((len(toxic), 3))
    for h in (0, 1):
        w, trans = _field(corpus, toxic, half != h, rounds)
        seen[half == h] = _evidence(corpus, w, trans, half == h)
    w, model.transition = _field(corpus, toxic, np.ones(len(toxic), bool), rounds)
    model.bias = float(w[-1])
    model.weights = {f: float(x) for f, x in zip(corpus.names, w, strict=False) if abs(x) > 1e-2}
    model.curve = _curve(seen, toxic, weight)
    return model


def _tokens(corpus: Corpus, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers and lengths of the chosen documents."""
    return corpus.flat[np.repeat(chosen, corpus.lengths)], corpus.lengths[chosen]


def _evidence(corpus: Corpus, w: np.ndarray, trans: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    flat, lengths = _tokens(corpus, chosen)
    emission = np.bincount(corpus.rows, w[corpus.cols], corpus.n_words) + w[-1]
    return evidence(marginals(emission[flat], lengths, trans), lengths)


def _field(corpus: Corpus, toxic: np.ndarray, chosen: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights of all features and the bias, and transitions, fitted on the chosen documents."""
    rows, cols = corpus.rows, corpus.cols
    flat, lengths = _tokens(corpus, chosen)
    y = token_labels(corpus, toxic, chosen).astype(float)
    first = np.cumsum(lengths) - lengths
    follows = np.ones(len(flat), bool)
    follows[first[lengths > 0]] = False
    at = np.flatnonzero(follows)
    seen_pairs = np.zeros((2, 2))
    np.add.at(seen_pairs, (y[at - 1].astype(int), y[at].astype(int)), 1)
    wanted = np.bincount(flat, y, corpus.n_words)
    w, moved, trans, trans_moved = np.zeros(len(corpus.names) + 1), np.full(len(corpus.names) + 1, 1e-3), np.zeros((2, 2)), np.full((2, 2), 1e-3)
    w[-1] = -4.0
    for _ in range(rounds):
        emission = np.bincount(rows, w[cols], corpus.n_words) + w[-1]
        p, expected = marginals(emission[flat], lengths, trans, pairs=True)
        off = wanted - np.bincount(flat, p, corpus.n_words)
        slope = np.append(np.bincount(cols, off[rows], len(corpus.names)), off.sum()) / 50 - 0.02 * w
        moved += slope**2
        w += 1.0 * slope / np.sqrt(moved)
        turn = (seen_pairs - expected) / 50 - 0.02 * trans
        trans_moved += turn**2
        trans += 0.3 * turn / np.sqrt(trans_moved)
    return w, trans


def evidence(p: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Per document: the largest marginal, the logarithm of their sum, and that of their share of the tokens.

    The share tells a long text that meets a listed start by chance from a text that has been made toxic.
    """
    top = np.zeros(len(lengths))
    owner = np.repeat(np.arange(len(lengths)), lengths)
    np.maximum.at(top, owner, p)
    total = np.bincount(owner, p, len(lengths))
    return np.stack([top, np.log1p(total), np.log1p(1_000 * total / np.maximum(lengths, 1))], axis=1)


def _curve(x: np.ndarray, toxic: np.ndarray, weight: np.ndarray, rounds: int = 30) -> tuple[float, ...]:
    """Weighted logistic regression by Newton's steps."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = x.T @ (x * (weight * p * (1 - p))[:, None]) + 0.05 * np.eye(len(w))
        w += np.linalg.solve(h, x.T @ (weight * (toxic - p)) - 0.05 * w)
    return tuple(float(v) for v in w)


def training_rows(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """(doc_id, text, toxic, total): at most ``sample_rows`` labelled rows of each class by a hash, and the size of the class.

    The held-out fifth teaches nothing, rows longer than ``sample_bytes`` are left to scoring, and equal rows count once.
    """
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    marked = marked.where("doc_id is not null and toxic in (0, 1)").where(~held_out("doc_id"))
    marked = marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    texts = documents(docs).withColumn("text_key", F.xxhash64("text"))
    known = texts.select("doc_id", "text_key", F.octet_length("text").alias("size")).join(marked, "doc_id").distinct()
    order = (F.xxhash64("doc_id", "text_key"), F.col("doc_id"), F.col("text_key"))
    totals = known.groupBy("toxic").agg(F.count(F.lit(1)).alias("total"))
    few = [known.where((F.col("toxic") == y) & (F.col("size") <= sample_bytes)).orderBy(*order).limit(sample_rows) for y in (0, 1)]
    chosen = few[0].unionByName(few[1]).drop("size").join(F.broadcast(totals), "toxic")
    found = texts.join(F.broadcast(chosen), ["doc_id", "text_key"])
    return found.groupBy("doc_id", "text_key", "toxic", "total").agg(F.first("text").alias("text")).select("doc_id", "text", "toxic", "total")


def held_out(column: str):
    return F.crc32(F.col(column).cast("string")) % 5 == 0


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES) -> Model:
    found = training_rows(docs, labels, sample_rows, sample_bytes).toArrow().sort_by([("doc_id", "ascending"), ("text", "ascending")])
    toxic = found.column("toxic").to_numpy().astype(np.int64)
    weight = found.column("total").to_numpy() / np.maximum(np.bincount(toxic, minlength=2), 1)[toxic]
    return fit(found.column("text").to_pylist(), toxic, weight)


class Scorer:
    """A model with the emissions of the words a worker has met."""

    def __init__(self, model: Model):
        self.model = model
        outer = self

        class Emissions(dict):
            def __missing__(self, word):
                if len(self) >= CACHE_SIZE:
                    self.clear()
                self[word] = out = outer.model.emission(plain(word))
                return out

        self.emissions = Emissions()

    def __call__(self, texts: list[str], with_spans: bool):
        found = [_TOKEN.findall(t.lower()) for t in texts]
        lengths = np.array([len(f) for f in found], np.int64)
        emission = np.fromiter((e for f in found for e in map(self.emissions.__getitem__, f)), float, int(lengths.sum()))
        p = marginals(emission, lengths, self.model.transition)
        scores = self.model.score(evidence(p, lengths))
        spans = [""] * len(texts)
        if with_spans:
            ends = np.cumsum(lengths)
            hit = np.flatnonzero(p >= 0.5)
            for d in np.unique(np.searchsorted(ends, hit, side="right")).tolist():
                spans[d] = _spans(texts[d], set((hit[(hit >= ends[d] - lengths[d]) & (hit < ends[d])] - (ends[d] - lengths[d])).tolist()))
        return scores, spans


def _spans(text: str, hit: set[int]) -> str:
    out: list[list[int]] = []
    before = -2
    for k, m in enumerate(_TOKEN.finditer(text)):
        if k in hit:
            if before == k - 1:
                out[-1][1] = m.end()
            else:
                out.append([m.start(), m.end()])
            before = k
    return ",".join(f"{a}:{b}" for a, b in out)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per document: score, predicted class and the offending spans."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches):
        scorer = Scorer(shared.value)
        for part in slices(batches, text_sizes, 2_000_000):
            values, spans = scorer(part.column("text").to_pylist(), True)
            out = [part.column("doc_id"), pa.array(values, pa.float64()), pa.array((values >= 0.5).astype(np.int32), pa.int32()), pa.array(spans, pa.string())]
            yield pa.RecordBatch.from_arrays(out, names=["doc_id", "score", "predicted", "spans"])

    return documents(docs).mapInArrow(scored, "doc_id long, score double, predicted int, spans string")


def toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    return score(docs, learn(docs, labels, sample_rows)).withColumn("held_out", F.coalesce(held_out("doc_id"), F.lit(False)))


def keep_clean(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Documents that are not predicted toxic, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, sample_rows))
    names = docs.columns

    def kept(batches):
        scorer = Scorer(shared.value)
        for part in slices(batches, text_sizes, 2_000_000):
            values, _ = scorer([t or "" for t in part.column("text").to_pylist()], False)
            yield part.filter(pa.array(values < 0.5))

    return docs.select(*names).mapInArrow(kept, docs.schema)
