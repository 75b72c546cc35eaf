"""A training-data pipeline over ``documents``: each stage works on all that the one before it kept.

Toxic documents go, one document of each group of near-duplicates stays, repeated byte strings are cut out, secrets are
masked, and what is left is packed into sequences. Stages are written as Parquet below the shared folder and read again,
so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skyledger.llm import bwt_dedup, dartminhash, packing, secrets, toxicity
from skyledger.llm.common import saved, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the tagger does not reject; it learns from the labels outside the held-out fifth."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the least id."""
    return dartminhash.keep_first(docs)


def cut_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the byte strings that also stand elsewhere; a document may be left empty."""
    return bwt_dedup.remove(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets masked."""
    return secrets.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document: the sequence and place it goes to."""
    return packing.best_fit_packing(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeated_strings),
    ("secret_scans", mask_secrets),
    ("best_fit_packing", pack_sequences),
]

#: Learning, tokenizing and packing are beyond SQL: the rows are tested against brute force on small tables.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
