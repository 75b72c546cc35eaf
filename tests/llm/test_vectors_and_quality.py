"""Vector codes, whitening and the byte network against plain versions, on the given tables and on odd rows."""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.llm import codes, quality_net, whitening

VECTORS = "vec_id long, embedding array<double>, label int, row string, part string, x int, a int, code string, n string"


def odd_vectors():
    """Nulls, repeats, ties, several lengths, empty and huge vectors; columns with names that the operators use."""
    rnd = np.random.default_rng(5)
    rows = [(i, (rnd.normal(size=8) * 3).tolist(), i % 5) for i in range(70)]
    rows += [(300 + i, rows[3][1], None) for i in range(60)] + [rows[0], rows[0], (0, rows[1][1], 9), (None, rows[2][1], 1), (None, rows[4][1], None)]
    rows += [(500 + i, rnd.integers(-2, 3, 6).tolist(), 2) for i in range(30)]
    rows += [(600, None, 1), (601, [None] + [1.0] * 7, 1), (602, [math.nan] * 8, 1), (603, [math.inf] * 8, 1), (604, [], 3), (605, [], 3), (606, [0.0] * 8, 1), (607, [2.5], 7)]
    rows += [(700 + i, [1e12 * i, -1e9, 0.0001, 5.0, 1e15], 4) for i in range(5)]
    return [(i, None if v is None else [None if c is None else float(c) for c in v], l, *["z", "z", 1, 1, "z", "z"]) for i, v, l in rows]


@pytest.fixture(scope="module")
def odd_table(spark):
    return spark.createDataFrame(odd_vectors(), VECTORS).repartition(4).cache()


def kept(df):
    rows = [(r.vec_id, r.embedding, r.label) for r in df.select("vec_id", "embedding", "label").collect()]
    return [r for r in rows if r[1] is not None and all(c is not None and math.isfinite(c) for c in r[1])]


def plain_codes(rows, entries=256, rounds=4):
    """(vec_id, label, code, error, label_error, digest) in whole numbers of Python."""
    out, spent = [], {}
    for d in {len(v) for _, v, _ in rows}:
        part = sorted([(i is None, i or 0, [math.floor(1024 * c) for c in v], l) for i, v, l in rows if len(v) == d], key=lambda r: r[:3])
        cuts = [(p * d // 4, (p + 1) * d // 4) for p in range(4)]
        pieces = [[r[2][a:b] for r in part] for a, b in cuts]
        books = [list(p[:entries]) for p in pieces]

        def nearest(piece, book):
            far = [sum((x - y) ** 2 for x, y in zip(piece, e, strict=True)) for e in book]
            return far.index(min(far)), min(far)

        for _ in range(rounds):
            for p in range(4):
                at = [nearest(x, books[p])[0] for x in pieces[p]]
                for e in set(at):
                    mine = [x for x, a in zip(pieces[p], at, strict=True) if a == e]
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
        digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
        for k, (gone, i, _, label) in enumerate(part):
            found = [nearest(pieces[p][k], books[p]) for p in range(4)]
            out.append((None if gone else i, label, "".join(f"{a:02x}" for a, _ in found), sum(f for _, f in found), digest))
            spent[label] = spent.get(label, 0) + out[-1][3]
    return [(i, l, c, min(e, 2**63 - 1), min(spent[l], 2**63 - 1), g) for i, l, c, e, g in out]


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("lengths, entries, owner_rows, rounds", [((0, 1, 5), 256, 100_000, 1), ((8,), 7, 10, 3)])
def test_codes(odd_table, lengths, entries, owner_rows, rounds):
    df = odd_table.where(f"embedding is null or size(embedding) in ({', '.join(map(str, lengths))})")
    got = codes.compress(df, entries=entries, owner_rows=owner_rows, rounds=rounds).collect()
    assert ordered(got) == ordered(plain_codes(kept(df), entries, rounds))


def test_codes_of_the_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    assert ordered(codes.compress(df).collect()) == ordered(plain_codes(kept(df)))


def test_members_that_stay_are_not_shuffled(spark):
    """A round sends on only the members whose entry has changed; salts spread those of a hot entry."""
    rows = spark.range(1000).selectExpr("id as row", "id as vec_id", "1 as label", "0 as position", "if(id < 900, 1, 0) as entry", "array(if(id % 10 = 0, 0L, 1000L)) as part")
    stay, move = codes._split(codes._assigned(rows, [np.array([[0], [1000]])]))
    assert stay.count() == 820 and {(r.entry, r.part[0]) for r in move.collect()} == {(0, 0), (1, 1000)} and move.count() == 180
    assert codes._migrate(move, 40).count() == 180 and move.where("entry = 0").count() == 90
    assert "Exchange" not in codes._assigned(rows, [np.array([[0], [1000]])])._jdf.queryExecution().executedPlan().toString()


def test_codes_of_nothing_and_of_unlabelled_vectors(spark, odd_table):
    none = codes.compress(odd_table.where("false"))
    assert none.collect() == [] and none.columns == ["vec_id", "label", "code", "error", "label_error", "codebooks_sha256"]
    bare = codes.compress(odd_table.where("size(embedding) = 6").drop("label"), rounds=1).collect()
    assert len(bare) == 30 and {r.label for r in bare} == {None} and len({r.label_error for r in bare}) == 1


def plain_whitening(rows, d, weights="counts"):
    """By row: deviation, and the absolute whitened values; n, what each component explains."""
    x = np.array([[math.floor(1024 * c) + 100_000 for c in v] for v in rows], object).reshape(-1, d)
    fitted = x if weights == "counts" else np.array(sorted(set(map(tuple, x))), object)
    n, s = len(fitted), fitted.sum(axis=0)
    off = (fitted * n - s).astype(float) / n
    e, u = np.linalg.eigh(off.T @ off / n)
    e, u = e[::-1][:8], u[:, ::-1][:, :8]
    values = (x * n - s).astype(float) / n @ u / np.sqrt(np.maximum(e, 1e-300))
    return [int(v) for v in ((x * n - s) ** 2).sum(axis=1)], np.abs(values), n, e / max(e.sum() if d <= 8 else np.trace(off.T @ off / n), 1e-300)


@pytest.mark.parametrize("weights", ["counts", "one"])
@pytest.mark.parametrize("hot", [10_000, 5])
def test_whitening(spark, odd_table, weights, hot):
    for df, d in ((odd_table.where("size(embedding) = 8"), 8), (spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet"), 64)):
        rows = kept(df)
        deviation, values, n, explained = plain_whitening([v for _, v, _ in rows], d, weights)
        got = whitening.whiten(df, weights=weights, hot_least=hot).collect()
        assert len(got) == 8 * len(rows) and {r.n for r in got} == {n}
        want = sorted((i is None, i or 0, c + 1, dev, round(values[k, c], 6)) for k, ((i, _, _), dev) in enumerate(zip(rows, deviation, strict=True)) for c in range(8))
        have = sorted((r.vec_id is None, r.vec_id or 0, r.component, r.deviation, abs(r.whitened)) for r in got)
        assert [w[:4] for w in want] == [h[:4] for h in have]
        assert max(abs(w[4] - h[4]) for w, h in zip(want, have, strict=True)) < 1e-5
        assert all(abs(r.explained - explained[r.component - 1]) < 1e-9 for r in got)
        assert {r.identity_error for r in got} and max(r.identity_error for r in got) < 1e-8


def test_whitening_of_odd_vectors(spark, odd_table):
    got = whitening.whiten(odd_table).collect()
    rows = kept(odd_table)
    assert len(got) == sum(min(8, len(v)) for _, v, _ in rows)
    one = [r for r in got if r.vec_id == 607]
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 1, 0, 0.0, 0.0, 1.0)]
    huge = [r for r in got if r.vec_id is not None and r.vec_id >= 700]
    deviation = plain_whitening([v for i, v, _ in rows if i is not None and i >= 700 and len(v) == 5], 5)[0]
    # beyond 2**52 components are taken for that, and beyond a long the deviation is a decimal only
    assert len(huge) == 25 and all((r.deviation is None) == (r.deviation_exact > 2**63 - 1) for r in huge) and len(deviation) == 5
    assert whitening.whiten(odd_table.where("false")).collect() == []
    with pytest.raises(ValueError):
        whitening.whiten(odd_table, weights="all")


def test_a_hot_vector_is_one_row_of_the_fit(spark):
    df = spark.range(3000).selectExpr("id as vec_id", "if(id % 3 = 0, array(1.0D, 2.0D), array(cast(id % 7 as double), cast(id % 11 as double))) as embedding")
    same = [ordered((r.vec_id, r.component, r.deviation, round(r.whitened, 9)) for r in whitening.whiten(df, hot_least=h).collect()) for h in (10, 10_000)]
    assert same[0] == same[1] and len(same[0]) == 6000


def test_chunks_cover_every_byte():
    hop = quality_net.CHUNK - quality_net.OVERLAP
    for n in (0, 1, quality_net.CHUNK, quality_net.CHUNK + 1, quality_net.CHUNK + hop, 5000):
        text = bytes(i % 251 for i in range(n))
        rows, count = quality_net.chunks([b"ab", text])
        assert count[0] == 1 and rows[0, :3].tolist() == [97, 98, quality_net.PAD]
        seen = {k * hop + j: int(v) for k, row in enumerate(rows[1:]) for j, v in enumerate(row) if v != quality_net.PAD}
        assert seen == dict(enumerate(text))


def test_slopes_by_differences():
    rnd = np.random.default_rng(1)
    net = quality_net.Network.fresh(2)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    texts = [bytes(rnd.integers(97, 123, n).tolist()) for n in (3, 700, 1300)]
    y, weight = np.array([0, 1, 0]), np.array([1.0, 2.0, 0.5])

    def loss():
        p = net(texts)
        return -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / weight.sum()

    slope = quality_net._slopes(net, texts, y, weight)
    for name, at in [("out", 3), ("out", 20), ("bias", 0), ("dense", (4, 5)), ("raise", 2), ("lift", 7), ("filters", (9, 4)), ("bytes", (110, 3))]:
        w, old, step = net.weights[name], net.weights[name][at], 1e-2
        w[at] = old + step
        up = loss()
        w[at] = old - step
        down = loss()
        w[at] = old
        assert abs((up - down) / (2 * step) - slope[name][at]) < 2e-2 * max(abs(slope[name][at]), 1e-2), name


def test_texts_score_alike_in_any_company(monkeypatch):
    net = quality_net.Network.fresh(3)
    texts = [b"", b"one", b"x" * 3000, bytes(range(256)) * 30, b"one"]
    together, alone = net(texts), np.array([net([t])[0] for t in texts])
    monkeypatch.setattr(quality_net, "HELD", 2000)
    assert np.allclose(together, alone, atol=1e-6) and np.allclose(net(texts), alone, atol=1e-6) and together[1] == pytest.approx(together[4])


def test_quality_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    got = quality_net.quality(docs, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.join(labels, "doc_id").where("held_out").select("predicted", "quality", "score").collect()
    low, high = ([r for r in rows if r.quality == y] for y in (0, 1))
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert sum(r.predicted for r in high) > 0.98 * len(high) and sum(r.predicted == 0 for r in low) > 0.75 * len(low)
    wins = sum(h.score > l.score for h in high for l in low)
    assert wins > 0.98 * len(high) * len(low)


def test_quality_of_odd_tables(spark):
    schema = "doc_id long, text string, score string, quality int, total int, size int"
    rows = [(5, "good words here", "s", 1, 1, 1), (5, "good words here", "s", 1, 1, 1), (9, None, "s", 0, 1, 1), (11, "", None, None, None, None), (None, "no id", None, None, None, None), (14, "long " * 40_000, "s", 1, 1, 1), (15, "!!! ### " * 50, "s", 1, 1, 1)]
    docs = spark.createDataFrame(rows, schema).repartition(3)
    labels = spark.createDataFrame([(5, 1, 1), (9, 1, 0), (None, 1, 1), (11, None, 0), (14, 1, None), (15, 0, 1), (14, 7, 1)], "doc_id long, quality int, toxic int")
    got = quality_net.quality(docs, labels).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows) and all(0 <= r.score <= 1 for r in got)
    assert {r.doc_id: r.held_out for r in got if r.doc_id is not None} == {r[0]: zlib.crc32(str(r[0]).encode()) % 5 == 0 for r in rows if r[0] is not None}
    assert len({r.score for r in got if r.doc_id in (9, 11)}) == 1
    assert {r.score for r in quality_net.quality(docs, labels.where("quality = 1")).collect()} == {1.0}
    assert {r.score for r in quality_net.quality(docs, labels.where("false")).collect()} == {0.0}
    assert quality_net.quality(docs.where("false"), labels).collect() == []
    sample = quality_net.training_rows(docs, labels, sample_bytes=1000).agg(F.max(F.length("text"))).first()[0]
    assert sample <= 1000
