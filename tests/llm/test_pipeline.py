"""The pipeline on the smallest tables, stage by stage, against plain versions."""

from __future__ import annotations

import zlib

import brute
import corpus_pipeline
import numpy as np

from skyledger.llm import byte_bpe, toxicity

SMALL = "/root/testdata/sf0.001"


def test_each_stage_takes_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    clean = corpus_pipeline.saved(stages["toxicity"](spark, docs, SMALL), "test")
    once = corpus_pipeline.saved(stages["minhash_near_dedup"](spark, clean, SMALL), "test")
    assert clean.columns == once.columns == docs.columns and clean.count() <= docs.count()
    bags = {r.doc_id: b for r in clean.collect() if (b := brute.bag(r.text))}
    first = brute.groups(bags, brute.near_links(bags))
    assert {r.doc_id for r in once.collect()} == {r.doc_id for r in clean.collect()} - {d for d, f in first.items() if d != f}
    cut = corpus_pipeline.saved(stages["suffix_array_dedup"](spark, once, SMALL), "test")
    left = {d: n - gone for d, n, gone, _, _ in brute.bwt([(r.doc_id, r.text) for r in once.collect()])}
    assert all(left[r.doc_id] - 8 <= len((r.text or "").encode()) <= left[r.doc_id] for r in cut.collect())
    masked = stages["secret_scans"](spark, cut, SMALL)
    assert masked.columns == docs.columns and not any(brute.ACCESS.search(r.text or "") for r in masked.collect())


def test_run_takes_every_stage_to_its_end(spark, monkeypatch):
    stored = {}

    def kept(df, purpose):
        stored[purpose.removeprefix("pipeline-")] = out = save(df, purpose)
        return out

    save = corpus_pipeline.saved
    monkeypatch.setattr(corpus_pipeline, "saved", kept)
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert list(stored) == [name for name, _ in corpus_pipeline.STAGES]
    docs, clean, once, cut, masked = ([(r.doc_id, r.text) for r in df.collect()] for df in (spark.read.parquet(f"{SMALL}/documents.parquet"), *list(stored.values())[:4]))
    found = toxicity.toxicity(spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet"))
    bad = {r.doc_id for r in found.collect() if r.predicted}
    assert bad and {d for d, _ in clean} == {d for d, _ in docs} - bad
    bags = {d: b for d, t in clean if (b := brute.bag(t))}
    first = brute.groups(bags, brute.near_links(bags))
    assert {d for d, _ in once} == {d for d, _ in clean} - {d for d, f in first.items() if d != f}
    left = {d: n - out for d, n, out, _, _ in brute.bwt(once)}
    assert len(cut) == len(once) and all(left[d] - 8 <= len((t or "").encode()) <= left[d] for d, t in cut)
    assert [d for d, _ in sorted(masked)] == [d for d, _ in sorted(cut)] and not any(brute.secrets(t)[0][1] for _, t in masked)
    coder, want = byte_bpe.load(), []
    for doc, text in masked:
        ids = coder.encode(text or "") + np.array([2], "<u4").tobytes()
        n, at, k = len(ids) // 4, 0, 0
        while at < n:
            size = n if n <= 1024 else (n - at) % 1024 or 1024
            want.append((doc, k, at, size, zlib.crc32(ids[4 * at : 4 * (at + size)])))
            at, k = at + size, k + 1
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    bins: dict = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        ends = [0, *(offset + length for offset, length in sorted(places))]
        assert [offset for offset, _ in sorted(places)] == ends[:-1] and ends[-1] <= 1024
    assert len(bins) <= 1.03 * -(-sum(w[3] for w in want) // 1024) + 1
