"""Counts of the stream tables, and produced against consumed events."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import md5_id
from ..plans.reports import table_counts
from .envelope import STREAM_TABLES
from .landing import COUNTS_TABLE, DLQ_TABLE, landed_since


def st_table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return table_counts(tables, "object_name")


def st_reconcile(
    produced: DataFrame,
    landed: DataFrame,
    dlq: DataFrame,
    run_id: str,
    duplicate_events: int = 0,
    per_topic_dlq: bool = False,
) -> DataFrame:
    """Produced against consumed events of each topic.

    ``produced`` has ``topic_name, produced_events``; ``landed`` and ``dlq`` are the tables. A topic
    passes when the gap is no more than the dead letters plus the duplicates. Dead letters of all topics
    count for each one, unless ``per_topic_dlq``.
    """
    consumed = landed.groupBy(F.col("kafka_topic").alias("topic_name")).agg(F.count(F.lit(1)).alias("consumed"))
    gap = F.col("produced_events") - F.col("consumed_events")
    rows = produced.join(consumed, "topic_name", "left")
    if per_topic_dlq:
        letters = dlq.groupBy(F.col("kafka_topic").alias("topic_name")).agg(F.count(F.lit(1)).alias("letters"))
        rows = rows.join(letters, "topic_name", "left").withColumn("dlq_events", F.coalesce("letters", F.lit(0)))
    else:
        rows = rows.withColumn("dlq_events", dlq.agg(F.count(F.lit(1))).scalar())
    return (
        rows.select(
            F.lit(run_id).alias("run_id"),
            "topic_name",
            "produced_events",
            F.coalesce("consumed", F.lit(0)).alias("consumed_events"),
            F.lit(duplicate_events).cast("bigint").alias("duplicate_events"),
            "dlq_events",
        )
        .withColumn("difference", gap)
        .withColumn(
            "status",
            F.when(F.col("difference") <= F.col("dlq_events") + F.col("duplicate_events"), "PASSED").otherwise("FAILED"),
        )
        .withColumn("reconciliation_id", md5_id("run_id", "topic_name"))
    )


def st_reconcile_run(spark: SparkSession, root: str, produced: DataFrame, since: dict[str, int], run_id: str) -> DataFrame:
    """The same for what one run landed: events, dead letters by topic, and duplicates since the progress at its start.

    Earlier runs do not count, so a run that loses messages cannot hide behind what others have landed.
    """
    tables = [landed_since(spark, root, table, since).select("kafka_topic") for table in STREAM_TABLES.values()]
    landed = reduce(DataFrame.unionByName, tables)
    counts = landed_since(spark, root, COUNTS_TABLE, since).agg(F.coalesce(F.sum("duplicates"), F.lit(0))).first()[0]
    return st_reconcile(produced, landed, landed_since(spark, root, DLQ_TABLE, since), run_id, counts, per_topic_dlq=True)
