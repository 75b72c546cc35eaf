"""Rules, dedupe, lookups, upserts and load control on hand-written rows, hot keys included."""

from __future__ import annotations

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from skyledger.operators import assertions, audit, dedupe, filters, incremental, inject, quality, rules
from skyledger.plans import features, marts, models
from skyledger.sources import versions

TEXT = ["booking_id", "customer_id", "flight_id", "flight_date", "ticket_price", "booking_status", "payment_status",
        "booking_channel"]


def bookings(spark, records):
    """Clean bookings with some fields replaced."""
    clean = dict(zip(TEXT, ["B-1", "C", "F", "2026-04-01", "10.5", "CONFIRMED", "PAID", "WEB"]))
    data = [tuple({**clean, **r}[c] for c in TEXT) + (n + 2, "b.csv") for n, r in enumerate(records)]
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in TEXT) + ", row_number bigint, file_path string")


def found(checked):
    return {(r.row_number, r.rule_name, r.bad_value) for r in checked.errors.collect()}


def test_every_booking_rule(spark):
    src = bookings(
        spark,
        [
            {"booking_id": "B-1"},
            {"booking_id": " b-1 "},
            {"booking_id": "\t", "flight_id": None},
            {"booking_id": "B-2", "flight_date": "2026"},
            {"booking_id": "B-3", "ticket_price": "ten"},
            {"booking_id": "B-4", "ticket_price": "-3", "customer_id": " "},
            {"booking_id": "B-5", "booking_status": "ON_HOLD", "payment_status": "unsure"},
            {"booking_id": "B-6", "booking_channel": "mobile app"},
            {"booking_id": "B-7", "booking_status": None, "payment_status": ""},
        ],
    )
    checked = quality.validate_bookings(src)
    assert found(checked) == {
        (3, "duplicate_event", "B-1"),
        (4, "required_not_null", "\t"),
        (4, "required_not_null", ""),
        (5, "valid_date", "2026"),
        (6, "valid_numeric", "ten"),
        (7, "negative_value", "-3"),
        (7, "missing_optional", ""),
        (8, "controlled_vocabulary", "ON_HOLD"),
        (8, "controlled_vocabulary", "unsure"),
        (9, "standardization_required", ""),
    }
    reasons = {r.row_number: (r.record_key, r.reason) for r in checked.quarantine.collect()}
    assert reasons == {
        4: ("row-4", "Missing booking_id; Missing flight_id"),
        5: ("B-2", "Invalid flight_date"),
        6: ("B-3", "Invalid ticket_price"),
    }
    assert checked.valid.count() + checked.quarantine.count() == src.count()


def test_report_counts_equal_the_tables(spark):
    columns = "payment_id string, booking_id string, amount string, refund_amount string, payment_status string, payment_method string, currency string, row_number bigint, file_path string"
    pay = spark.createDataFrame(
        [
            ("P-1", "B-1", "5", "0", "PAID", "VISA", "USD", 2, "p"),
            ("P-1", "B-1", "5", "1", "CHARGEBACK", "VISA", "USD", 3, "p"),
            ("P-2", "B-404", "5", "1", "REFUNDED", "VISA", "USD", 4, "p"),
            ("", "B-1", "x", "0", "paid", "VISA", "USD", 5, "p"),
        ],
        columns,
    )
    checked = quality.validate_payments(pay, bookings(spark, [{}]))
    row = checked.outcome.first()
    assert row.valid_rows == checked.valid.count() == 2
    assert row.quarantined_rows == checked.quarantine.count() == 2
    assert row.record_error_rows == checked.errors.count()
    assert ("relationship_missing", "B-404") in {(r.rule_name, r.bad_value) for r in checked.errors.collect()}
    assert ("refund_status_mismatch", "CHARGEBACK") in {(r.rule_name, r.bad_value) for r in checked.errors.collect()}


def test_schema_gate_raises(rows):
    good = rows([("a", "f", [], 1)], "source_name string, file_path string, missing_columns array<string>, row_count bigint")
    quality.schema_gate(good)
    with pytest.raises(ValueError, match="'b'"):
        quality.schema_gate(good.unionByName(rows([("b", "f", ["x"], 1)], good.schema)))


def test_keep_latest_limits_before_the_shuffle(spark):
    df = spark.range(10_000).selectExpr("if(id % 3 = 0, -1, id) as key", "id as version")
    latest = dedupe.keep_latest(df, ["key"], ["version"])
    plan = plan_of(latest)
    assert plan.index("Partial") > plan.index("Exchange") > plan.index("Final")
    hot = latest.where("key = -1").collect()
    assert [(r.key, r.version) for r in hot] == [(-1, 9999)]
    assert latest.count() == df.select("key").distinct().count()


def test_keep_latest_puts_null_versions_first(rows):
    df = rows([(1, None, 1), (1, 5, 2)], "k int, updated int, n int")
    assert dedupe.keep_latest(df, ["k"], ["updated", "n"]).first().n == 1


def test_repeats_on_a_hot_key(spark):
    df = spark.range(3000).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) as key", "id as n", "id * 2 as extra")
    again = dedupe.repeats(df, ["key"], ["n"], ("extra",))
    assert again.count() == 999
    assert again.agg(F.min("n")).first()[0] == 3


@pytest.mark.parametrize("how", ["left_semi", "left_anti", "left"])
@pytest.mark.parametrize("hot_known", [True, False])
def test_key_lookup_equals_plain_join_under_skew(spark, how, hot_known):
    df = spark.range(6000).selectExpr(
        "id", "case when id % 3 = 0 then 'hot' when id % 7 = 0 then null else cast(id % 500 as string) end as key"
    )
    known = spark.range(0, 500, 2).selectExpr("cast(id as string) as key")
    if hot_known:
        known = known.union(spark.sql("select 'hot'"))
    plain = df.join(known, "key", how).select("id", "key")
    found = filters.key_lookup(df, known, "key", how).select("id", "key")
    assert found.exceptAll(plain).count() == plain.exceptAll(found).count() == 0


def test_rows_in_builds_without_a_job(spark):
    df = spark.range(1000).selectExpr("id", "id % 10 as day")
    keys = spark.range(3).withColumnRenamed("id", "day")
    spark.sparkContext.setJobGroup("rows_in", "building only")
    both = [filters.rows_in(df, keys, "day", anti) for anti in (False, True)]
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("rows_in")
    assert [x.count() for x in both] == [300, 700]


def test_repeats_tell_records_of_several_files_apart(rows):
    df = rows([("f1", 2, "A"), ("f1", 3, ""), ("f2", 2, "A"), ("f2", 3, ""), ("f2", 4, " a ")], "file_path string, row_number bigint, booking_id string")
    found = quality.duplicate_event(df, "booking_id", "again").collect()
    assert {(r.file_path, r.row_number) for r in found} == {("f2", 2), ("f2", 4)}


def test_merge_keeps_what_delete_insert_keeps_without_a_partition(spark, rows, tmp_path):
    schema = "k int, day string, v int"
    old = rows([(1, None, 1), (2, None, 1), (3, "a", 1), (4, "b", 1), (5, "b", 1)], schema)
    for new in (rows([(2, "a", 2), (6, None, 2)], schema), rows([(1, "a", 2)], schema), rows([(4, None, 2)], schema)):
        house = versions.Warehouse(spark, str(tmp_path / str(hash(str(new.collect())))))
        for rows_of_run in (old, new):
            change = house.begin()
            change.delete_insert("t", rows_of_run, "day", ["k"])
            change.commit()
        got = sorted(map(str, house.read("t").select("k", "day", "v").collect()))
        assert got == sorted(map(str, incremental.delete_insert(old, new, "day", ["k"]).select("k", "day", "v").collect()))


@pytest.mark.parametrize("text,good", [("2026-04-01", True), ("2026-04-01 10:00:00", True), ("2026-04-01T10:00:00Z", True), ("2026-04-01 garbage", False), ("2026-04-01Tjunk", False), ("2026-04-01T", False), ("2026-13-01", False), ("", False)])
def test_the_whole_text_is_a_date(rows, text, good):
    from skyledger.functions import try_date

    assert (rows([(text,)], "c string").select(try_date("c")).first()[0] is not None) == good


def test_upsert_updates_only_the_named_columns(rows):
    target = rows([(1, "a", "x"), (2, "b", None)], "k int, name string, state string")
    new = rows([(2, "B", None), (2, "B2", "later"), (3, "c", "new")], "k int, name string, state string")
    out = incremental.upsert(target, new, ["k"], ["state"], [F.col("name").desc()])
    assert sorted(map(tuple, out.collect())) == [(1, "a", "x"), (2, "b", "later"), (3, "c", "new")]
    again = incremental.upsert(out, new, ["k"], ["state"], [F.col("name").desc()])
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, out.collect()))


def test_upsert_can_set_null(rows):
    target, new = rows([(1, "old")], "k int, error string"), rows([(1, None)], "k int, error string")
    assert incremental.upsert(target, new, ["k"], ["error"]).first().error is None


def test_insert_missing_is_idempotent(rows):
    target, new = rows([(1, "a")], "k int, v string"), rows([(1, "z"), (2, "b"), (2, "c")], "k int, v string")
    first = incremental.insert_missing(target, new, ["k"], [F.col("v").asc()])
    assert [tuple(r) for r in first.collect()] == [(2, "b")]
    assert incremental.insert_missing(target.union(first), new, ["k"]).count() == 0


def test_delete_insert_keeps_only_untouched_rows(rows):
    schema = "id int, day string, v int"
    old = rows([(1, "d1", 1), (2, "d2", 1), (3, "d3", 1), (4, "d1", 1)], schema)
    new = rows([(1, "d1", 2), (3, "d9", 2)], schema)
    out = incremental.delete_insert(old, new, "day", ["id"])
    assert sorted(map(tuple, out.collect())) == [(1, "d1", 2), (2, "d2", 1), (3, "d9", 2)]


def test_merge_partitions_equals_delete_insert_and_leaves_other_files(spark, rows, tmp_path):
    schema = "id int, v int, day string"
    old = rows([(1, 1, "d1"), (2, 1, "d2"), (3, 1, "d3"), (4, 1, "d1"), (5, 1, "d3")], schema)
    new = rows([(1, 2, "d1"), (3, 2, "d9")], schema)
    house = versions.Warehouse(spark, str(tmp_path))
    first = house.begin()
    first.replace("t", old, ["day"])
    first.commit()
    untouched = [f for f in house.table("t").folders if f.endswith("day=d2")]
    want = sorted(map(tuple, incremental.delete_insert(old, new, "day", ["id"]).collect()))
    for _ in range(2):
        change = house.begin()
        change.delete_insert("t", new, "day", ["id"])
        change.commit()
        assert sorted(map(tuple, house.read("t").collect())) == want
    assert [f for f in house.table("t").folders if f.endswith("day=d2")] == untouched


def _files(rows, checksum):
    return rows(
        [("bookings", "raw.raw_bookings", "dt=1/b.csv", checksum, 10, 9, 1)],
        "source_name string, target_table string, file_path string, checksum_md5 string, source_rows bigint, "
        "valid_rows bigint, quarantined_rows bigint",
    )


def test_loading_a_b_a_loads_a_again(spark, rows):
    log = spark.createDataFrame([], audit.LOAD_AUDIT)
    statuses = []
    for day, content in enumerate(["A", "A", "B", "A", "A"], start=1):
        at = F.lit(f"2026-05-0{day} 00:00:00").cast("timestamp")
        loads = audit.load_outcomes(_files(rows, content), log)
        statuses.append(loads.first().load_status)
        log = spark.createDataFrame(audit.audit_rows(f"run-{day}", loads, log, at).collect(), audit.LOAD_AUDIT)
    assert statuses == ["LOADED", "SKIPPED_ALREADY_LOADED", "LOADED", "LOADED", "SKIPPED_ALREADY_LOADED"]
    assert audit.files_to_load(_files(rows, "A"), log).count() == 0
    assert audit.files_to_load(_files(rows, "B"), log).count() == 1


def test_rerun_of_one_run_does_not_forget_its_load(spark, rows):
    log = spark.createDataFrame([], audit.LOAD_AUDIT)
    statuses = []
    for hour in range(3):
        at = F.lit(f"2026-05-01 0{hour}:00:00").cast("timestamp")
        loads = audit.load_outcomes(_files(rows, "A"), log)
        statuses.append(loads.first().load_status)
        log = spark.createDataFrame(audit.audit_rows("run", loads, log, at).collect(), audit.LOAD_AUDIT)
    assert statuses == ["LOADED", "SKIPPED_ALREADY_LOADED", "SKIPPED_ALREADY_LOADED"]
    assert log.count() == 1


def test_reconciliation_gate(rows):
    report = rows([("a", 10, 1, 9), ("b", 5, 0, 5)], "source_name string, row_count bigint, quarantined_rows bigint, valid_rows bigint")
    raw = rows([("a", "raw.a", 9)], "source_name string, target_table string, actual_raw_rows bigint")
    out = audit.reconcile(report, raw, "run")
    assert {(r.source_name, r.difference, r.status) for r in out.collect()} == {("a", 0, "PASSED"), ("b", -5, "FAILED")}
    with pytest.raises(ValueError, match="'b'"):
        audit.require_reconciled(out)
    audit.require_reconciled(out.where("source_name = 'a'"))


def test_assertions_find_what_is_broken(rows):
    df = rows([(1, "A"), (1, "B"), (None, "C"), (2, None)], "k int, v string")
    assert assertions.as_not_null(df, "k").count() == 1
    assert [tuple(r) for r in assertions.as_unique(df, ["k"]).collect()] == [(1, 2)]
    assert {r.v for r in assertions.as_accepted_values(df, "v", ["A", "B"]).collect()} == {"C"}
    parent = rows([(2,)], "id int")
    assert [tuple(r) for r in assertions.as_relationships(df, "k", parent, "id").collect()] == [(1, 2)]


def test_a_suite_scans_each_model_once(spark, rows, tmp_path):
    child = rows([(1, "A", 5.0, 1), (1, "B", -1.0, None), (2, "C", None, 2), (None, "A", 2.0, 9), (7, None, -3.0, 9)], "k int, v string, x double, p bigint")
    parent = rows([(1, 1), (2, 2), (2, 2), (None, 3)], "id int, other int")
    for name, df in (("child", child), ("parent", parent)):
        df.write.parquet(str(tmp_path / name))
    models_ = {name: spark.read.parquet(str(tmp_path / name)) for name in ("child", "parent")}
    a = assertions
    checks = [
        a.not_null("child", "k"), a.not_null("child", "x"), a.not_null("parent", "other"), a.non_negative("child", "x"), a.unique("child", "k"), a.unique("child", "k", "v"),
        a.unique("parent", "id", "other"), a.accepted("child", "v", ["A", "B"]), a.related("child", "k", "parent", "id"), a.related("child", "p", "parent", "other"), a.related("child", "p", "child", "k"),
    ]
    got = a.suite(models_, checks)
    assert [tuple(r) for r in got.collect()] == [(c.model, c.test, c.name(), n) for c, n in zip(checks, [1, 1, 0, 2, 1, 0, 1, 1, 1, 2, 2])]
    assert plan_of(a.suite(models_, checks)).count("FileScan") == 2
    empty = {name: df.where("false") for name, df in models_.items()}
    assert {r.failures for r in a.suite(empty, checks).collect()} == {0}


def test_route_mart_never_fans_out(spark, rows):
    days = rows(
        [("A-B", "A", "B", "d1", 10, 4.0, 2, 1), ("A-B", "A", "B", "d2", 5, 10.0, 1, 0)],
        "route string, origin_airport string, destination_airport string, flight_date string, flight_count bigint, "
        "avg_delay_minutes double, delayed_flight_count bigint, cancelled_flight_count bigint",
    )
    bridge = rows(
        [("f1", "A-B", "d1", 2, 20.0), ("f2", "A-B", "d1", 1, 5.0), ("f3", "A-B", "d1", 1, 0.0)],
        "flight_id string, route string, flight_date string, booking_count bigint, confirmed_revenue double",
    )
    got = marts.mart_route_performance(days, bridge).first()
    assert (got.booking_count, got.revenue) == (4, 25.0)
    assert got.avg_delay_minutes == pytest.approx((4.0 * 3 + 10.0) / 4)
    assert got.delayed_rate == pytest.approx((2 * 3 + 1) / (10 * 3 + 5))
    safe = marts.mart_route_performance_grain_safe(days, bridge).first()
    assert safe.delayed_rate == pytest.approx(3 / 15)


def test_customer_lifecycle(rows):
    schema = "customer_id string, booking_status string, ticket_price decimal(18,2), booking_time timestamp_ntz"
    from decimal import Decimal

    data = [("one", "CONFIRMED", Decimal(9000), None)]
    data += [("rich", "CONFIRMED", Decimal(1250), None)] * 2 + [("back", "CANCELLED", Decimal(9000), None)] * 2
    got = {r.customer_id: r.lifecycle_segment for r in models.int_customer_booking(rows(data, schema)).collect()}
    assert got == {"one": "NEW", "rich": "HIGH_VALUE", "back": "RETURNING"}


def test_failed_feature_job_is_audited_and_raised(spark):
    seen = {}
    bad = spark.range(1).withColumnRenamed("id", "FlightDate")

    def write(df, name):
        seen[name] = df.collect()

    with pytest.raises(Exception):
        features.run_feature_job(spark, bad, bad, "run", write)
    row = seen["spark_job_audit"][0]
    assert row.status == "FAILED" and 0 < len(row.error_message) <= 2000


def test_injection_does_not_depend_on_partitioning(spark):
    df = spark.range(2000).selectExpr("id", "'CALL_CENTER' as v")
    col = inject.inj_text("v", "id", 0.3, 7).alias("out")
    a, b = df.repartition(1).select("id", col), df.repartition(13).select("id", col)
    assert a.exceptAll(b).count() == 0
    dirty = a.where("out != 'CALL_CENTER'")
    assert 0.25 < dirty.count() / 2000 < 0.35
    assert {r.out for r in dirty.select("out").distinct().collect()} == {"call_center", "Call_Center", " CALL_CENTER ", "CALL CENTER"}


def test_equal_error_ids_keep_the_earlier_rule(spark):
    src = bookings(spark, [{"booking_id": "", "flight_id": ""}])
    log = quality.validate_bookings(src).errors
    assert log.count() == 2
    stored = audit.persist_errors(log, "run", log.limit(0)).collect()
    assert [r.column_name for r in stored] == ["booking_id"]


def test_error_ids_are_stable(spark):
    src = bookings(spark, [{"ticket_price": "x"}])
    row = rules.error_log(src, quality.booking_rules(), "booking_id", "bookings", F.col("file_path")).first()
    import hashlib

    assert row.error_id == hashlib.md5(f"bookings|{row.file_path}|2|valid_numeric|B-1|x".encode()).hexdigest()
