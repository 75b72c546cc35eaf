"""Queries that SQL can express against their SQL, and links among the given vectors after near copies are planted."""

from __future__ import annotations

import brute
import compare
import numpy as np
import pytest

from skyledger.llm import hnsw
from skyledger.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_its_sql(spark, name):
    verdict, detail = compare.compare(spark, compare.duck(SMALL), SMALL, name, QUERIES[name], ORACLES[name])
    assert verdict == "ok", detail


def test_planted_copies_of_the_given_vectors_are_linked(spark):
    given = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    rnd = np.random.default_rng(9)
    planted = []
    for k in range(60):
        v = np.array(given[7 * k][1])
        # some just above the threshold, some just below, some exact copies
        noise = rnd.normal(size=len(v)) * np.linalg.norm(v) / np.sqrt(len(v)) * (0, 0.25, 0.31, 0.36)[k % 4]
        planted.append((10_000 + k, (v + noise).tolist()))
    df = spark.createDataFrame([*given, *planted], "vec_id long, embedding array<float>").repartition(4)
    plain = [(r.vec_id, r.embedding) for r in df.collect()]
    links = brute.cosine_links(plain)
    group = brute.groups([i for i, _ in plain], links)
    got = {r.vec_id: r for r in hnsw.near_duplicates(df).collect()}
    assert len(links) >= 30
    assert {i: (r.n_links, r.component_id) for i, r in got.items()} == {i: (sum(i in p for p in links), group[i]) for i, _ in plain}
