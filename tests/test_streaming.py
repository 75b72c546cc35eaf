"""Landing once over redelivery, replay and restart; dead letters; reconciliation."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from skyledger.sources.messages import MESSAGE_SCHEMA, read_messages, to_messages, with_offsets
from skyledger.streaming import envelope, landing
from skyledger.streaming.reconcile import st_reconcile, st_reconcile_run


def message(offset, topic="booking_events", raw=None, **change):
    body = {
        "event_id": f"e{offset}", "event_type": "BOOKING_CREATED", "event_time": "2026-04-01T10:00:00Z",
        "source_system": "s", "schema_version": 1, "entity_key": "k", "payload": {"booking_status": "CONFIRMED"},
    }
    body.update(change)
    body = {k: v for k, v in body.items() if v != "absent"}
    return (topic, 0, offset, "k", raw if raw is not None else json.dumps(body))


@pytest.fixture()
def messages(spark):
    return lambda data: spark.createDataFrame(data, MESSAGE_SCHEMA)


@pytest.mark.parametrize(
    "change,kind,text",
    [
        ({}, None, None),
        ({"schema_version": "2"}, None, None),
        ({"payload": {}}, None, None),
        ({"raw": "{not json"}, "JSONDecodeError", "message is not JSON"),
        ({"raw": "[1]"}, "AttributeError", "message must be an object"),
        ({"event_id": ""}, "ValueError", "Missing required envelope fields: event_id"),
        ({"event_id": None, "payload": None}, "ValueError", "Missing required envelope fields: event_id, payload"),
        ({"schema_version": "absent"}, "ValueError", "Missing required envelope fields: schema_version"),
        ({"payload": ""}, "ValueError", "Missing required envelope fields: payload"),
        ({"payload": "text"}, "ValueError", "payload must be an object"),
        ({"payload": [1]}, "ValueError", "payload must be an object"),
        ({"event_time": "yesterday"}, "ValueError", "Invalid isoformat string: 'yesterday'"),
        ({"schema_version": "x"}, "ValueError", "invalid literal for int() with base 10: 'x'"),
        ({"topic": "other"}, "ValueError", "Unsupported topic: other"),
    ],
)
def test_envelope_errors(messages, change, kind, text):
    row = envelope.st_validate_envelope(messages([message(1, **change)])).first()
    assert (row.error_type, row.error_message) == (kind, text)


def counts(spark, root):
    total = landing.read_landed(spark, root, landing.COUNTS_TABLE)
    return tuple(total.agg(*[F.sum(c) for c in ("seen", "inserted", "duplicates", "dlq")]).first())


def landed(spark, root, table="raw_booking_events_stream"):
    return sorted((r.event_id, r.kafka_offset) for r in landing.read_landed(spark, root, table).collect())


def test_redelivery_within_and_across_batches(spark, messages, tmp_path):
    root = str(tmp_path)
    again = lambda offset, event: message(offset, event_id=event)
    landing.land_batch(messages([message(1), again(2, "e1"), message(3), message(4, raw="{bad")]), 0, root)
    landing.land_batch(messages([again(5, "e1"), message(6), message(7, topic="payment_events")]), 1, root)
    assert landed(spark, root) == [("e1", 1), ("e3", 3), ("e6", 6)]
    assert landed(spark, root, "raw_payment_events_stream") == [("e7", 7)]
    assert counts(spark, root) == (7, 4, 2, 1)


def test_replayed_batch_rewrites_itself(spark, messages, tmp_path):
    root = str(tmp_path)
    batch = messages([message(1), message(2), message(3, raw="{bad")])
    landing.land_batch(messages([message(0)]), 0, root)
    for _ in range(2):
        landing.land_batch(batch, 1, root)
    assert landed(spark, root) == [("e0", 0), ("e1", 1), ("e2", 2)]
    assert landing.read_landed(spark, root, landing.DLQ_TABLE).count() == 1
    assert counts(spark, root) == (4, 3, 0, 1)


def test_stream_restarts_from_its_checkpoint(spark, messages, tmp_path):
    inbox, root = str(tmp_path / "in"), str(tmp_path / "out")
    for wave in ([message(1), message(2)], [message(3), message(4, event_id="e1")], []):
        if wave:
            messages(wave).coalesce(1).write.mode("append").parquet(inbox)
        landing.st_commit_batches(read_messages(spark, inbox, max_per_batch=1), f"{root}/cp", root)
    assert landed(spark, root) == [("e1", 1), ("e2", 2), ("e3", 3)]
    assert counts(spark, root) == (4, 3, 1, 0)


def test_a_new_checkpoint_keeps_what_was_landed(spark, messages, tmp_path):
    root = str(tmp_path / "out")
    waves = ([message(1), message(2), message(3, raw="{bad")], [message(4), message(5, event_id="e1"), message(6, raw="{bad")])
    for n, wave in enumerate(waves):
        inbox = str(tmp_path / f"in{n}")
        messages(wave).coalesce(1).write.parquet(inbox)
        landing.st_commit_batches(read_messages(spark, inbox), f"{root}/cp{n}", root)
    assert landed(spark, root) == [("e1", 1), ("e2", 2), ("e4", 4)]
    assert landing.read_landed(spark, root, landing.DLQ_TABLE).count() == 2
    assert counts(spark, root) == (6, 3, 1, 2)


def _files(spark, messages, inbox, first, last, each=2):
    """One file for each few messages, in order."""
    for n in range(first, last):
        messages([message(each * n + k) for k in range(each)]).coalesce(1).write.mode("append").parquet(inbox)


def test_a_batch_reads_nothing_that_its_stream_has_landed(spark, messages, tmp_path, monkeypatch):
    """Files read by the comparison of each of many batches: none, however many were landed before."""
    inbox, root, read = str(tmp_path / "in"), str(tmp_path / "out"), []
    data = [message(n // 2 if n % 2 else 1000 + n, event_id=f"e{n // 2}") for n in range(100)]
    spark.createDataFrame(data, MESSAGE_SCHEMA).repartition(12).write.parquet(inbox)
    plain = landing.read_landed

    def counted(session, at, table, other_than=None):
        df = plain(session, at, table, other_than)
        if other_than is not None:
            read.append(len(df.inputFiles()))
        return df

    monkeypatch.setattr(landing, "read_landed", counted)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        landing.st_commit_batches(read_messages(spark, inbox, max_per_batch=1), f"{root}/cp", root)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(read) >= 24 and set(read) == {0}
    monkeypatch.undo()
    rows = landing.read_landed(spark, root, "raw_booking_events_stream")
    assert rows.count() == rows.select("event_id").distinct().count() == 50
    total = counts(spark, root)
    assert total == (100, 50, 50, 0)
    files = len(rows.inputFiles())
    landing.compact(spark, root, keep=1, older_than=0)
    after = landing.read_landed(spark, root, "raw_booking_events_stream")
    assert after.count() == 50 and len(after.inputFiles()) < files and counts(spark, root) == total


def test_the_first_delivery_of_a_batch_lands(spark, messages, tmp_path):
    inbox, root = str(tmp_path / "in"), str(tmp_path / "out")
    messages([message(n, event_id=f"e{n % 3}") for n in range(30, 0, -1)]).repartition(4).write.parquet(inbox)
    landing.st_commit_batches(read_messages(spark, inbox), f"{root}/cp", root)
    assert landed(spark, root) == [("e0", 3), ("e1", 1), ("e2", 2)]


def test_a_run_stops_after_so_many_messages_and_loses_none(spark, messages, tmp_path):
    inbox, root = str(tmp_path / "in"), str(tmp_path / "out")
    _files(spark, messages, inbox, 0, 8)
    taken = landing.st_commit_batches(read_messages(spark, inbox, max_per_batch=1), f"{root}/cp", root, max_events=6, idle_seconds=120)
    first = len(landed(spark, root))
    assert 6 <= taken <= first < 16
    landing.st_commit_batches(read_messages(spark, inbox, max_per_batch=1), f"{root}/cp", root)
    assert [o for _, o in sorted(landed(spark, root), key=lambda r: r[1])] == list(range(16))
    assert counts(spark, root) == (16, 16, 0, 0)


def test_a_run_stops_when_nothing_comes(spark, messages, tmp_path):
    inbox, root = str(tmp_path / "in"), str(tmp_path / "out")
    _files(spark, messages, inbox, 0, 2)
    for more in (0, 1):
        if more:
            _files(spark, messages, inbox, 2, 3)
        assert landing.st_commit_batches(read_messages(spark, inbox), f"{root}/cp", root, max_events=1000, idle_seconds=2) == (2 if more else 4)
    assert counts(spark, root) == (6, 6, 0, 0)


def test_a_run_is_reconciled_by_what_it_landed(spark, messages, rows, tmp_path):
    root = str(tmp_path)
    landing.land_batch(messages([message(n) for n in range(8)]), 0, root)
    since = landing.progress(spark, root)
    landing.land_batch(messages([message(20), message(21, event_id="e1"), message(22, raw="{bad"), message(23, topic="payment_events")]), 1, root)
    produced = rows([("booking_events", 6), ("payment_events", 1)], "topic_name string, produced_events bigint")
    got = {r.topic_name: (r.consumed_events, r.dlq_events, r.duplicate_events, r.status) for r in st_reconcile_run(spark, root, produced, since, "r").collect()}
    assert got == {"booking_events": (1, 1, 1, "FAILED"), "payment_events": (1, 0, 1, "PASSED")}
    assert st_reconcile_run(spark, root, produced, landing.progress(spark, root), "r").first().consumed_events == 0


def test_offsets_without_gaps_in_source_order(spark, rows):
    data = [(i, "t" if i % 5 else "u", None if i % 11 == 0 else f"k{i % 7}", f"v{i}") for i in range(1, 400, 2)]
    got = with_offsets(rows(data, "row_index bigint, topic string, key string, value string").repartition(5), block=10).collect()
    assert len({(r.topic, r.key, r.partition) for r in got}) == len({(r.topic, r.key) for r in got})
    groups: dict = {}
    for r in sorted(got, key=lambda r: r.row_index):
        groups.setdefault((r.topic, r.partition), []).append(r.kafka_offset)
    assert len(groups) > 3 and all(g == list(range(len(g))) for g in groups.values())
    start = spark.createDataFrame([("t", p, 100) for p in range(3)], "topic string, partition int, next_offset bigint")
    later = with_offsets(rows(data, "row_index bigint, topic string, key string, value string"), block=10, start=start).collect()
    assert sorted((r.row_index, r.kafka_offset + (100 if r.topic == "t" else 0)) for r in got) == sorted((r.row_index, r.kafka_offset) for r in later)


def test_watermark_dedupe(spark, messages, tmp_path):
    inbox = str(tmp_path / "in")
    messages([message(1), message(2, event_id="e1"), message(3)]).write.parquet(inbox)
    events = envelope.st_validate_envelope(read_messages(spark, inbox))
    query = (
        landing.within_watermark(events, "1 hour")
        .writeStream.format("memory").queryName("once")
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert spark.table("once").count() == 2


def test_envelope_fallbacks_and_limit(spark, rows):
    schema = "row_index bigint, booking_id string, booking_status string, booking_time string, created_at string, updated_at string"
    src = rows(
        [(1, "B-1", " confirmed ", "t1", "c1", "u1"), (2, "", "VOID", "t2", "c2", ""), (3, "B-3", None, "", "c3", None)], schema
    )
    events = envelope.st_build_envelope(src, envelope.BOOKING)
    got = [(r.event_type, r.event_time, r.entity_key) for r in events.orderBy("row_index").collect()]
    assert got == [
        ("BOOKING_CREATED", "u1", "B-1"),
        ("BOOKING_UPDATED", "t2", "missing-booking-2"),
        ("BOOKING_UPDATED", "c3", "B-3"),
    ]
    sent = to_messages(events, "booking_events", n=2)
    assert sent.count() == 2
    back = envelope.st_validate_envelope(sent.selectExpr("topic", "0 as partition", "0L as kafka_offset", "value"))
    assert {r.event_id for r in back.collect()} == {r.event_id for r in events.collect() if r.row_index <= 2}


def test_stream_reconciliation_rule(spark, rows):
    produced = rows([("booking_events", 10), ("payment_events", 5)], "topic_name string, produced_events bigint")
    landed_rows = rows([("booking_events",)] * 7, "kafka_topic string")
    dlq = rows([("booking_events",)] * 3, "kafka_topic string")
    got = {r.topic_name: (r.difference, r.status) for r in st_reconcile(produced, landed_rows, dlq, "r").collect()}
    assert got == {"booking_events": (3, "PASSED"), "payment_events": (5, "FAILED")}
    per_topic = st_reconcile(produced, landed_rows, dlq, "r", per_topic_dlq=True)
    assert {r.topic_name: r.dlq_events for r in per_topic.collect()} == {"booking_events": 3, "payment_events": 0}
