"""The registered queries: each operator on its whole table, with the digests that its contract names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bwt_dedup, codes, collision, dartminhash, hnsw, packing, quality_net, secrets, superkmer, token_counts, toxicity, tree_bpe, whitening
from .common import table
from .oracle import ORACLES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(query):
    QUERIES[query.__name__] = query
    return query


def _sha(column: str):
    return F.sha2(F.col(column).cast("binary"), 256).alias("kept_sha256")


@register
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_scan(table(spark, sf_dir, "documents"))


@register
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted", "spans")


@register
def op3_superkmer_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = superkmer.remove_repeated_windows(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", _sha("kept"))


@register
def op4_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dartminhash.near_duplicates(table(spark, sf_dir, "documents"))


@register
def op5_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree_bpe.digest(table(spark, sf_dir, "documents"))


@register
def op6_hnsw_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.near_duplicates(table(spark, sf_dir, "embeddings"))


@register
def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_packing(table(spark, sf_dir, "documents"))


@register
def op8_bwt_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bwt_dedup.repeated_bytes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", _sha("kept"))


@register
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


@register
def op10_collision_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return collision.search(rows, rows.where("vec_id % 20 = 0"))


@register
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(table(spark, sf_dir, "embeddings")).drop("label")


@register
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@register
def op13_byte_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_net.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


__all__ = ["ORACLES", "QUERIES"]
