"""Figures that must not grow faster than the input: shuffles, tables that are written, rows of one task, splits."""

from __future__ import annotations

from conftest import SF_DIR, plan_of
from pyspark.sql import functions as F

from skyledger.checks import fixtures, q_models
from skyledger.checks.fixtures import Tables
from skyledger.operators import assertions as a


def _writes(monkeypatch, name="write_table"):
    """Names and plans of the tables that are stored from now on."""
    seen, real = {}, fixtures.tables.write_table

    def write(df, root, layer, table, *args, **kwargs):
        seen[table] = plan_of(df)
        return real(df, root, layer, table, *args, **kwargs)

    monkeypatch.setattr(fixtures.tables, name, write)
    monkeypatch.setattr(fixtures, "_stored", {})
    return seen


def test_stored_projections_are_written_without_a_shuffle(spark, monkeypatch):
    seen = _writes(monkeypatch)
    t = Tables(spark, SF_DIR)
    assert t.raw_flights.count() == t.given("lineitem").count()
    assert t.payments.count() == t.bookings.count() >= t.raw_bookings.count()
    assert set(seen) == {"flights", "raw_flights", "payments", "bookings", "raw_bookings"}
    assert [name for name, plan in seen.items() if "Exchange" in plan] == []


def test_a_suite_stores_only_the_tables_of_its_models(spark, monkeypatch):
    seen = _writes(monkeypatch)
    used = {c.model for c in q_models._ACCEPTED}
    assert set(q_models._models(Tables(spark, SF_DIR), used)) == used
    assert set(seen) == {"bookings", "raw_bookings"}


def test_a_suite_shuffles_each_value_once(rows):
    models = {"child": rows([(1, 2), (1, 3), (5, 3)], "k int, p int"), "parent": rows([(2, 1), (2, 1)], "id int, k int")}
    checks = [a.unique("child", "k"), a.accepted("child", "k", ["1"]), a.related("child", "p", "parent", "id"), a.related("child", "k", "parent", "k"), a.unique("parent", "id"), a.unique("child", "p")]
    assert [r.failures for r in a.suite(models, checks).collect()] == [1, 1, 2, 1, 1, 1]
    assert plan_of(a.suite(models, checks)).count("Exchange hashpartitioning") == 1


def test_records_of_several_files_are_numbered_by_block(spark):
    from skyledger.checks.q_quality import numbered

    rows = spark.range(400).selectExpr("id * 7919 % 100003 as k", "cast(id % 2 as int) as dup", "concat('f', id % 3) as file_path", "-1L as row_number")
    want = rows.drop("row_number").selectExpr("*", "row_number() over (partition by file_path order by k, dup) + 1 as row_number")
    got = numbered(rows, block=10_000)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
    # every sort of rows is one of a file's block; only counts are gathered by file
    assert all("_block" in line for line in plan_of(got).splitlines() if "row_number()" in line and "Window [" in line)


def test_new_versions_meet_the_narrow_current_ones_in_one_join(spark, monkeypatch):
    from skyledger.plans import upkeep

    plans, order = [], ["a", "b"]
    versions = [None, 1, 2]
    pairs = [(p, q, r, s) for p in versions for q in versions for r in versions for s in versions]
    df = spark.createDataFrame(pairs, "a int, b int, _old_a int, _old_b int")
    top = [9 if x is None else x for x in versions]
    rank = dict(zip(versions, top))
    for r in df.withColumn("later", upkeep._later(order)).collect():
        assert r.later == ((rank[r.a], rank[r.b]) > (rank[r._old_a], rank[r._old_b])), r

    class Held:
        def read_keys(self, name, fresh):
            return fresh.where("booking_id = 'x'").withColumn("row_number", F.col("row_number") - 1)

    fresh = spark.createDataFrame([("x", 5, "d", "c", "n"), ("y", 1, "d", "c", "n")], "booking_id string, row_number int, flight_date string, customer_id string, note string")
    fresh = fresh.withColumns({"updated_at": F.lit(1), "loaded_at": F.lit(None).cast("int")})
    monkeypatch.setattr(upkeep, "written", lambda df, purpose: plans.append(plan_of(df)) or df)
    got = {r.booking_id: (r._known, r._old_date) for r in upkeep._changed(Held(), fresh).collect()}
    assert got == {"x": (True, "d"), "y": (None, None)}
    assert "Window" not in plans[0]


def test_the_number_of_csv_splits_is_bounded(spark, tmp_path, monkeypatch):
    from skyledger.checks import q_sources

    folder = str(tmp_path / "notes")
    spark.range(60_000).selectExpr("id", "repeat('x', 20) as note").coalesce(1).write.option("header", True).csv(folder)
    rows = spark.read.text(folder).count()
    monkeypatch.setattr(q_sources, "_SPLIT_BYTES", 1 << 10)
    monkeypatch.setattr(q_sources, "_SPLITS", 20)
    read = q_sources._split_session(Tables(spark, SF_DIR), folder).read.text(folder)
    assert read.count() == rows
    assert 10 <= read.rdd.getNumPartitions() <= 22
