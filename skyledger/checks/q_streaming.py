"""Envelopes, landing, dead letters, counts and reconciliation, on a real stream where state matters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import work_folder
from ..sources.messages import read_messages
from ..streaming import landing
from ..streaming.envelope import BOOKING, st_build_envelope
from ..streaming.reconcile import st_reconcile_run, st_table_counts
from .fixtures import Tables
from .q_reports import _STREAM_RECON, stream_reconciliation
from .q_sources import _rows
from .registry import register


def _streamed(t: Tables) -> str:
    """Land the messages through a stream and return its root folder.

    First deliveries (even offsets) come first. Redeliveries (odd offsets) come in a second run that
    starts from the checkpoint of the first.
    """
    root, inbox = work_folder(t.spark, "stream"), work_folder(t.spark, "inbox")
    for wave in (0, 1):
        arrived = t.messages.where(F.col("kafka_offset") % 2 == wave)
        arrived.write.mode("append").parquet(inbox)
        stream = read_messages(t.spark, inbox, max_per_batch=1000)
        landing.st_commit_batches(stream, f"{root}/checkpoint", root)
    return root


def _landed(t: Tables, root: str):
    out = None
    for table in landing.STREAM_TABLES.values():
        one = landing.read_landed(t.spark, root, table)
        out = one if out is None else out.unionByName(one)
    return out


_EVENT = ["event_id", "event_type", "event_time", "source_system", "schema_version", "entity_key",
          "kafka_topic", "kafka_partition", "kafka_offset"]
_EVENT_SQL = ", ".join("event_time::varchar as event_time" if c == "event_time" else c for c in _EVENT)


@register("src_stream_messages", "select topic, partition, kafka_offset, value from messages")
def _(t: Tables):
    inbox, out = work_folder(t.spark, "inbox"), work_folder(t.spark, "copied")
    t.messages.write.parquet(inbox)
    stream = read_messages(t.spark, inbox, max_per_batch=1000)
    (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", f"{out}-checkpoint")
        .trigger(availableNow=True)
        .start(out)
        .awaitTermination()
    )
    return t.spark.read.parquet(out).select("topic", "partition", "kafka_offset", "value")


_ENVELOPE = """select row_number-1 as row_index, 'booking-'||substr(h,1,8)||'-'||substr(h,9,4)||'-5'||substr(h,14,3)||'-'||
 substr('89ab',1+('0x'||substr(h,17,1))::int%4,1)||substr(h,18,3)||'-'||substr(h,21,12) as event_id,
 case upper(trim(booking_status)) when 'CONFIRMED' then 'BOOKING_CREATED' when 'CANCELLED' then 'BOOKING_CANCELLED' else 'BOOKING_UPDATED' end as event_type,
 updated_at as event_time, 'synthetic_streaming_demo' as source_system, 1 as schema_version,
 case when booking_id='' then 'missing-booking-'||(row_number-1) else booking_id end as entity_key, ticket_price as payload_price
from (select *, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8')||encode(case when booking_id='' then 'row-'||(row_number-1) else booking_id end||'|'||updated_at||'|'||(row_number-1))) as h
 from bookings) z"""


@register("st_build_envelope", _ENVELOPE)
def _(t: Tables):
    events = st_build_envelope(_rows(t.bookings, BOOKING), BOOKING)
    return events.select(
        "row_index", "event_id", "event_type", "event_time", "source_system", "schema_version", "entity_key",
        F.col("payload.ticket_price").alias("payload_price"),
    )


@register(
    "st_validate_envelope",
    f"select {_EVENT_SQL}, payload_k, error_type, error_message from env where error_type is null union all "
    "select event_id, event_type, event_time::varchar, source_system, schema_version, entity_key, kafka_topic, kafka_partition, kafka_offset, payload_k, "
    "error_type, error_message from env where error_type is not null",
)
def _(t: Tables):
    k = F.get_json_object("payload", "$.k").alias("payload_k")
    return t.envelopes.select(*_EVENT, k, "error_type", "error_message")


@register(
    "st_route_topic",
    f"select {_EVENT_SQL}, payload_k, case kafka_topic when 'booking_events' then 'raw_booking_events_stream' else 'raw_payment_events_stream' end as landing_table from env where error_type is null",
)
def _(t: Tables):
    """The events of each topic under the table that they go to."""
    k, out = F.get_json_object("payload", "$.k").alias("payload_k"), None
    for topic, table in landing.STREAM_TABLES.items():
        one = landing.st_route_topic(t.envelopes, topic).select(*_EVENT, k, F.lit(table).alias("landing_table"))
        out = one if out is None else out.unionByName(one)
    return out


@register("st_idempotent_land", f"select {_EVENT_SQL}, payload_k from landed")
def _(t: Tables):
    k = F.get_json_object("payload", "$.k").alias("payload_k")
    return _landed(t, _streamed(t)).select(*_EVENT, k)


_DLQ = ["dlq_id", "kafka_topic", "kafka_partition", "kafka_offset", "event_id", "entity_key", "error_type", "error_message"]


@register("st_dead_letter", f"select {', '.join(_DLQ)}, value as raw_message from dlq")
def _(t: Tables):
    return landing.read_landed(t.spark, _streamed(t), landing.DLQ_TABLE).select(*_DLQ, "raw_message")


@register(
    "st_run_counts",
    """select (select count(*) from messages) as seen, (select count(*) from landed) as inserted,
 (select count(*) from messages)-(select count(*) from landed)-(select count(*) from dlq) as duplicates, (select count(*) from dlq) as dlq""",
)
def _(t: Tables):
    counts = landing.read_landed(t.spark, _streamed(t), landing.COUNTS_TABLE)
    return counts.agg(*[F.sum(name).alias(name) for name in ("seen", "inserted", "duplicates", "dlq")])


@register(
    "st_commit_batches",
    """select 'landed' as what, count(*) as n, count(distinct event_id) as ids from landed union all select 'dead letters', count(*), count(distinct dlq_id) from dlq""",
)
def _(t: Tables):
    """The stream runs, and runs again from its checkpoint with nothing new."""
    root, inbox = work_folder(t.spark, "stream"), work_folder(t.spark, "inbox")
    t.messages.write.parquet(inbox)
    for _run in range(2):
        landing.st_commit_batches(read_messages(t.spark, inbox), f"{root}/checkpoint", root)
    rows, letters = _landed(t, root), landing.read_landed(t.spark, root, landing.DLQ_TABLE)
    return rows.agg(
        F.lit("landed").alias("what"), F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("ids")
    ).unionByName(
        letters.agg(
            F.lit("dead letters").alias("what"), F.count(F.lit(1)).alias("n"), F.count_distinct("dlq_id").alias("ids")
        )
    )


@register("st_reconcile", _STREAM_RECON.format(run="run-1", dup=0))
def _(t: Tables):
    return stream_reconciliation(t, "run-1", 0).drop("reconciliation_id")


register("st_table_counts", "select * from stream_counts")(lambda t: st_table_counts(t.stream_tables))


@register(
    "st_reconcile_run",
    """select 'run-2' as run_id, p.topic as topic_name, p.n as produced_events, coalesce(c.n,0) as consumed_events, d.n as duplicate_events, coalesce(q.n,0) as dlq_events,
 p.n-coalesce(c.n,0) as difference, case when p.n-coalesce(c.n,0)<=coalesce(q.n,0)+d.n then 'PASSED' else 'FAILED' end as status
from (select topic, count(*) as n from messages where kafka_offset%2=1 group by 1) p
left join (select kafka_topic, count(distinct event_id) as n from env where error_type is null and kafka_offset%2=1 and event_id not in (select event_id from env where error_type is null and kafka_offset%2=0) group by 1) c on c.kafka_topic=p.topic
left join (select kafka_topic, count(*) as n from env where error_type is not null and kafka_offset%2=1 group by 1) q on q.kafka_topic=p.topic,
 (select count(*) filter (where event_id in (select event_id from env where error_type is null and kafka_offset%2=0)) as n from env where error_type is null and kafka_offset%2=1) d""",
)
def _(t: Tables):
    """The second of two runs, which receives redelivered events only, by its own counts."""
    root, inbox, since = work_folder(t.spark, "stream"), work_folder(t.spark, "inbox"), {}
    for wave in (0, 1):
        arrived = t.messages.where(F.col("kafka_offset") % 2 == wave)
        arrived.write.mode("append").parquet(inbox)
        since = landing.progress(t.spark, root)
        landing.st_commit_batches(read_messages(t.spark, inbox), f"{root}/checkpoint", root)
    produced = arrived.groupBy(F.col("topic").alias("topic_name")).agg(F.count(F.lit(1)).alias("produced_events"))
    return st_reconcile_run(t.spark, root, produced, since, "run-2").drop("reconciliation_id")
