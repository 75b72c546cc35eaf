"""Reading event messages, and making them from envelopes with keys, partitions and offsets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import written

BOOKING_TOPIC, PAYMENT_TOPIC = "booking_events", "payment_events"
MESSAGE_SCHEMA = "topic string, partition int, kafka_offset bigint, key string, value string"


def read_messages(
    spark: SparkSession,
    source: str,
    brokers: str | None = None,
    topics: tuple[str, ...] = (BOOKING_TOPIC, PAYMENT_TOPIC),
    max_per_batch: int | None = None,
) -> DataFrame:
    """A stream of messages from the earliest on.

    ``source`` is ``kafka`` or a folder of Parquet files of messages. ``max_per_batch`` bounds a
    micro-batch: offsets for Kafka, files for a folder. Run it with ``trigger(availableNow=True)`` to
    stop at what is there now.
    """
    if source == "kafka":
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", brokers)
            .option("subscribe", ",".join(topics))
            .option("startingOffsets", "earliest")
        )
        if max_per_batch:
            reader = reader.option("maxOffsetsPerTrigger", max_per_batch)
        return reader.load().select(
            "topic",
            "partition",
            F.col("offset").alias("kafka_offset"),
            F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("value"),
        )
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if max_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_per_batch)
    return reader.parquet(source)


def to_messages(envelopes: DataFrame, topic: str, n: int | None = None) -> DataFrame:
    """Keyed JSON messages of the envelopes, with their place in the source; with ``n`` only its first ``n`` records."""
    chosen = envelopes if n is None else envelopes.where(F.col("row_index") <= n)
    body = [name for name in chosen.columns if name != "row_index"]
    return chosen.select(
        "row_index",
        F.lit(topic).alias("topic"),
        F.col("entity_key").alias("key"),
        F.to_json(F.struct(*body), {"ignoreNullFields": "false"}).alias("value"),
    )


PARTITIONS = 3
#: Source records whose messages are numbered together.
OFFSET_BLOCK = 100_000


def partition_of(key: Column | str, partitions: int = PARTITIONS) -> Column:
    """The partition of a key: by the first 32 bits of its MD5, the same in every engine; a null key goes to 0."""
    bits = F.conv(F.substring(F.md5(F.coalesce(key, F.lit(""))), 1, 8), 16, 10).cast("bigint")
    return F.when(F.isnull(key), 0).otherwise(bits % partitions).cast("int")


def with_offsets(
    messages: DataFrame, order: str = "row_index", partitions: int = PARTITIONS, start: DataFrame | None = None, block: int = OFFSET_BLOCK
) -> DataFrame:
    """Add ``partition`` and ``kafka_offset``: gap-free from 0 in each partition of a topic, in source order.

    Two passes: messages are counted by topic, partition and block of source records, a running sum over the blocks of a
    partition gives the offset at which each block starts, and a message adds its place within its block. So no task
    sorts more than the messages of one block and partition. ``start`` (topic, partition, next_offset) continues what was
    sent before. Equal places in the source are told apart by key and value.
    """
    placed = messages.withColumns({"partition": partition_of("key", partitions), "_block": F.floor(F.col(order) / block)})
    group = ["topic", "partition", "_block"]
    counts = written(placed.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")), "offset-blocks")
    before = Window.partitionBy("topic", "partition").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    if start is not None:
        begin = start.select("topic", "partition", F.col("next_offset").alias("_next"))
        starts = starts.join(begin, ["topic", "partition"], "left").withColumn("_start", F.col("_start") + F.coalesce("_next", F.lit(0)))
    place = F.row_number().over(Window.partitionBy(*group).orderBy(order, "key", "value"))
    numbered = placed.withColumn("_place", place).join(starts.select(*group, "_start"), group)
    return numbered.withColumn("kafka_offset", F.col("_start") + F.col("_place") - 1).drop("_block", "_place", "_start")
