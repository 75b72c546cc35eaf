"""Landing events once, dead letters, counts, and the stream that drives them.

A micro-batch is committed to a warehouse folder as one version (``sources.versions``): its events, dead letters and counts
are visible together or not at all, and a batch that is replayed after a failure finds itself committed and changes
nothing. Tables are cut by the stream that landed their rows.

Which event ids a stream has seen is kept as keyed state of the query (``dropDuplicates`` in RocksDB), so a batch never
reads what its own stream has landed, however long it runs. Ids that other streams landed below the same root, before this
one had its checkpoint, are compared by a join with their ids alone. ``compact`` gathers the folders of many batches.
"""

from __future__ import annotations

import threading
import time

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..functions import md5_id
from ..operators.dedupe import keep_first
from ..sources.versions import Transaction, Warehouse
from .envelope import STREAM_TABLES, st_validate_envelope

CONSUMER_GROUP = "skyledger-stream-loader"
DLQ_TABLE, COUNTS_TABLE = "streaming_dlq", "streaming_run_counts"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

EVENT_COLUMNS = [
    "event_id", "event_type", "event_time", "source_system", "schema_version", "entity_key",
    "kafka_topic", "kafka_partition", "kafka_offset", "payload",
]
EVENT_SCHEMA = (
    "event_id string, event_type string, event_time timestamp, source_system string, schema_version int, "
    "entity_key string, kafka_topic string, kafka_partition int, kafka_offset bigint, payload string, "
    "ingested_at timestamp, batch_id bigint, stream string"
)
DLQ_SCHEMA = (
    "dlq_id string, consumer_group string, kafka_topic string, kafka_partition int, kafka_offset bigint, "
    "event_id string, entity_key string, error_type string, error_message string, raw_message string, "
    "created_at timestamp, batch_id bigint, stream string"
)
COUNTS_SCHEMA = "seen bigint, inserted bigint, duplicates bigint, dlq bigint, batch_id bigint, stream string"


def st_route_topic(events: DataFrame, topic: str) -> DataFrame:
    """Valid events of one topic, in the columns of its landing table."""
    valid = events.where(F.col("error_type").isNull() & (F.col("kafka_topic") == topic))
    return valid.select(*EVENT_COLUMNS)


def first_deliveries(events: DataFrame) -> DataFrame:
    """One row per event id, the one delivered first."""
    return keep_first(events, ["event_id"], [F.col("kafka_partition").asc(), F.col("kafka_offset").asc()])


def not_landed(events: DataFrame, landed: DataFrame) -> DataFrame:
    """First deliveries of events the table does not hold; only its event ids are read."""
    return first_deliveries(events).join(landed.select("event_id"), "event_id", "left_anti")


def dead_letters(events: DataFrame, consumer_group: str = CONSUMER_GROUP) -> DataFrame:
    """Invalid events; the id follows from the message position, so a replay gives the same one."""
    return events.where(F.col("error_type").isNotNull()).select(
        md5_id("kafka_topic", "kafka_partition", "kafka_offset").alias("dlq_id"),
        F.lit(consumer_group).alias("consumer_group"),
        "kafka_topic",
        "kafka_partition",
        "kafka_offset",
        "event_id",
        "entity_key",
        "error_type",
        "error_message",
        F.col("value").alias("raw_message"),
    )


def _schema(table: str) -> str:
    return {DLQ_TABLE: DLQ_SCHEMA, COUNTS_TABLE: COUNTS_SCHEMA}.get(table, EVENT_SCHEMA)


def read_landed(spark: SparkSession, root: str, table: str, other_than: str | None = None) -> DataFrame:
    """A landing table; before the first batch it is empty. ``other_than`` leaves one stream's folders unread."""
    house = Warehouse(spark, root)
    if house.table(table) is None:
        return spark.createDataFrame([], _schema(table))
    return house.read(table, where=None if other_than is None else lambda part: part != f"stream={other_than}")


def progress(spark: SparkSession, root: str) -> dict[str, int]:
    """The last batch of each stream that is committed now; kept at the start of a run, it tells what the run lands."""
    return Warehouse(spark, root).manifest()[1]["progress"]


def landed_since(spark: SparkSession, root: str, table: str, since: dict[str, int]) -> DataFrame:
    """The rows of a landing table that were committed after ``since``."""
    before = F.lit(False)
    for stream, batch in since.items():
        before = before | ((F.col("stream") == stream) & (F.col("batch_id") <= batch))
    return read_landed(spark, root, table).where(~before)


def _append(change: Transaction, table: str, rows: DataFrame, batch_id: int, stream: str) -> int:
    """Add the rows of a batch to a table; their number, from the footers of what was written."""
    names = [name.split(" ")[0] for name in _schema(table).split(", ")]
    if change.table(table) is None:
        change.replace(table, rows.sparkSession.createDataFrame([], _schema(table)), ["stream"])
    marked = rows.withColumns({"batch_id": F.lit(batch_id).cast("bigint"), "stream": F.lit(stream)}).select(*names)
    return change.append(table, marked).count()


def st_idempotent_land(change: Transaction, events: DataFrame, batch_id: int, stream: str = "none", fresh: DataFrame | None = None) -> int:
    """Add each valid event of a validated batch once over the life of its table; the number of events added.

    ``fresh`` holds the ids (kafka_topic, event_id) that the stream's state had not seen before this batch. Without it
    the batch is compared with all that was landed, else with what other streams have.
    """
    root, spark, added = change.warehouse.root, events.sparkSession, 0
    for topic, table in STREAM_TABLES.items():
        first = first_deliveries(st_route_topic(events, topic))
        if fresh is not None:
            first = first.join(fresh.where(F.col("kafka_topic") == topic).select("event_id"), "event_id", "left_semi")
        landed = read_landed(spark, root, table, other_than=None if fresh is None else stream)
        rows = first.join(landed.select("event_id"), "event_id", "left_anti")
        added += _append(change, table, rows.withColumn("ingested_at", F.current_timestamp()), batch_id, stream)
    return added


def st_dead_letter(change: Transaction, events: DataFrame, batch_id: int, stream: str = "none") -> int:
    """Add the invalid events of a validated batch; their number."""
    return _append(change, DLQ_TABLE, dead_letters(events).withColumn("created_at", F.current_timestamp()), batch_id, stream)


def st_run_counts(change: Transaction, seen: int, inserted: int, dlq: int, batch_id: int, stream: str = "none") -> None:
    """Add one row with the seen, inserted, duplicate and dead-letter messages of a batch, as its writes counted them."""
    row = [(seen, inserted, seen - inserted - dlq, dlq)]
    _append(change, COUNTS_TABLE, change.warehouse.spark.createDataFrame(row, "seen bigint, inserted bigint, duplicates bigint, dlq bigint"), batch_id, stream)


def _land(events: DataFrame, batch_id: int, root: str, stream: str, fresh: DataFrame | None = None) -> None:
    """Write a validated batch and commit it, unless it is committed already."""
    house = Warehouse(events.sparkSession, root)
    if house.progress(stream) >= batch_id:
        return
    change = house.begin()
    dlq = st_dead_letter(change, events, batch_id, stream)
    inserted = st_idempotent_land(change, events, batch_id, stream, fresh)
    st_run_counts(change, events.count(), inserted, dlq, batch_id, stream)
    change.commit(progress=(stream, batch_id))


def land_batch(messages: DataFrame, batch_id: int, root: str, stream: str = "none") -> None:
    """Validate one batch of messages and land it; without a stream's state, all landed ids are compared."""
    events = st_validate_envelope(messages).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        _land(events, batch_id, root, stream)
    finally:
        events.unpersist()


#: Every message is read, and counted by its source, once for itself and once for its id.
BRANCHES = 2


def _with_new_ids(stream: DataFrame) -> DataFrame:
    """Validated messages, and marked rows for the ids among them that the state of the query has not seen."""
    events = st_validate_envelope(stream)
    ids = events.where(F.col("error_type").isNull()).select("kafka_topic", "event_id").dropDuplicates(["kafka_topic", "event_id"])
    return events.withColumn("_new", F.lit(False)).unionByName(ids.withColumn("_new", F.lit(True)), allowMissingColumns=True)


class Bounds(StreamingQueryListener):
    """Tells when a query has taken so many messages, or none for so long; batches count once they are committed."""

    def __init__(self, query_id: str, max_events: int | None, idle_seconds: float | None):
        self.query_id, self.max_events, self.idle_seconds = query_id, max_events, idle_seconds
        # a query is idle from its first report on, not while it starts
        self.events, self.last, self.reached = 0, None, threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if str(event.progress.id) != self.query_id:
            return
        rows = event.progress.numInputRows // BRANCHES
        self.events += rows
        if rows or self.last is None:
            self.last = time.monotonic()
        self._judge()

    def onQueryIdle(self, event) -> None:
        if str(event.id) == self.query_id:
            self.last = self.last or time.monotonic()
            self._judge()

    def onQueryTerminated(self, event) -> None:
        if str(event.id) == self.query_id:
            self.reached.set()

    def _judge(self) -> None:
        enough = self.max_events is not None and self.events >= self.max_events
        idle = self.idle_seconds is not None and self.last is not None and time.monotonic() - self.last >= self.idle_seconds
        if enough or idle:
            self.reached.set()


def _start(stream: DataFrame, checkpoint: str, root: str, land=None, **trigger) -> StreamingQuery:
    def write(df: DataFrame, batch_id: int) -> None:
        # Spark keeps a query's id in its checkpoint: the same after a restart, another for a new checkpoint
        query_id = df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        both = df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            fresh = both.where("_new").select("kafka_topic", "event_id")
            _land(both.where("not _new").drop("_new"), batch_id, root, query_id, fresh)
        finally:
            both.unpersist()

    conf = stream.sparkSession.conf
    before = conf.get(STATE_STORE)
    conf.set(STATE_STORE, ROCKSDB)  # a query keeps the settings that it was started with
    try:
        return _with_new_ids(stream).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()
    finally:
        conf.set(STATE_STORE, before)


def st_commit_batches(
    stream: DataFrame, checkpoint: str, root: str, max_events: int | None = None, idle_seconds: float | None = None, poll_seconds: float = 0.5
) -> int | None:
    """Land messages; the checkpoint commits offsets after each batch's data.

    Without bounds, all that is there now. With ``max_events`` the query stops after the batch that reaches this number
    of messages, with ``idle_seconds`` when none has come for so long; whichever is first. A batch that stopping cuts
    off is landed by the next run from the checkpoint, so none is lost and none lands twice. Returns the number of
    messages taken, if there was a bound.
    """
    if max_events is None and idle_seconds is None:
        _start(stream, checkpoint, root, availableNow=True).awaitTermination()
        return None
    query = _start(stream, checkpoint, root, processingTime=f"{poll_seconds} seconds")
    bounds, streams = Bounds(query.id, max_events, idle_seconds), stream.sparkSession.streams
    streams.addListener(bounds)
    try:
        while query.isActive and not bounds.reached.wait(poll_seconds):
            # an idle query reports seldom
            if not (query.status["isTriggerActive"] or query.status["isDataAvailable"]):
                bounds._judge()
        query.stop()
        if failure := query.exception():
            raise failure
    finally:
        streams.removeListener(bounds)
    return bounds.events


def compact(spark: SparkSession, root: str, keep: int = 2, older_than: float = 7 * 24 * 3600) -> None:
    """Gather the folders of many batches, and remove those that only versions before the last ``keep`` name."""
    house = Warehouse(spark, root)
    change = house.begin()
    for table in (*STREAM_TABLES.values(), DLQ_TABLE, COUNTS_TABLE):
        if change.table(table) is not None:
            change.compact(table)
    change.commit()
    house.vacuum(keep, older_than)


def within_watermark(events: DataFrame, delay: str) -> DataFrame:
    """Bounded-state alternative: repeats of an event id within the delay are dropped in the stream."""
    return events.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["event_id"])
