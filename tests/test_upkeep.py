"""Incremental upkeep equals a full rebuild, and reads and writes only what has changed."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from skyledger import schemas
from skyledger.plans import marts, models, staging, upkeep
from skyledger.sources.versions import Warehouse


def bookings(spark, rows):
    """Raw bookings of (id, version time, customer, day, price, status, record number)."""
    df = spark.createDataFrame(rows, "booking_id string, updated_at string, customer_id string, day int, price double, booking_status string, row_number bigint")
    given = {
        "flight_date": F.date_add(F.lit("2026-04-01").cast("date"), "day"), "ticket_price": F.col("price"), "booking_time": F.lit("2026-03-01 10:00:00"),
        "created_at": F.lit("2026-03-01 00:00:00"), "airline": F.lit("AA"), "origin_airport": F.lit("A01"), "destination_airport": F.lit("A02"), "flight_id": F.concat(F.lit("F"), "day"),
        "booking_channel": F.lit("WEB"), "customer_segment": F.lit("NEW"), "currency": F.lit("USD"), "payment_status": F.lit("PAID"), "is_refunded": F.lit("false"), "route": F.lit("A01-A02"),
    }
    df = df.withColumns(given)
    typed = [F.col(n).cast(k).alias(n) for n, k in schemas.RAW_BOOKINGS.items()]
    return df.select(*typed, "row_number", F.lit("2026-05-01 00:00:00").cast("timestamp_ntz").alias("loaded_at"))


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def same_as_full(house, raw):
    fact = models.fact_booking(staging.stg_bookings(raw))
    assert rows_of(house.read(upkeep.FACT).select(*fact.columns)) == rows_of(fact)
    for name, plan in ((upkeep.SALES, marts.mart_sales_performance), (upkeep.CUSTOMERS, models.dim_customer), (upkeep.CUSTOMER_BOOKINGS, models.int_customer_booking)):
        want = plan(fact)
        assert rows_of(house.read(name).select(*want.columns)) == rows_of(want), name


@pytest.fixture()
def house(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "house"))


def test_runs_over_late_equal_and_repeated_versions_equal_a_full_run(spark, house):
    rnd, rows = random.Random(4), []
    for n in range(240):
        time = None if n % 50 == 49 else f"2026-03-{1 + rnd.randint(0, 20):02d} 0{rnd.randint(0, 3)}:00:00"
        rows.append((f"b{rnd.randint(0, 50)}", time, f"c{rnd.randint(0, 9)}", rnd.randint(0, 6), float(rnd.randint(1, 900)), rnd.choice(["CONFIRMED", "CANCELLED"]), n))
    for run, upto in enumerate((90, 150, 150, 240)):
        raw = bookings(spark, rows[:upto])
        new = upkeep.refresh_bookings(house, raw, "40 days")
        assert (new == 0) == (run == 2)
        same_as_full(house, raw)


def test_a_day_reads_and_writes_its_own_partitions(spark, house, monkeypatch):
    rows = [(f"b{n}", "2026-03-05 00:00:00", f"c{n % 40}", n % 20, 100.0, "CONFIRMED", n) for n in range(400)]
    upkeep.refresh_bookings(house, bookings(spark, rows))
    before = {name: set(house.table(name).folders) for name in (upkeep.FACT, upkeep.SALES, upkeep.CUSTOMERS)}
    # two bookings of day 3 change, one of them moves to a day that was not there; one customer has none left
    rows += [("b3", "2026-03-06 00:00:00", "c3", 3, 70.0, "CANCELLED", 900), ("b23", "2026-03-06 00:00:00", "new", 30, 90.0, "CONFIRMED", 901)]
    listed, plain = [], Warehouse._rows

    def watched(self, name, held, folders):
        if name == upkeep.FACT:
            listed.append({f.partition("/")[2] for f in folders})
        return plain(self, name, held, folders)

    monkeypatch.setattr(Warehouse, "_rows", watched)
    assert upkeep.refresh_bookings(house, bookings(spark, rows), label="day 3") == 2
    monkeypatch.undo()
    assert set.union(*listed) <= {"flight_date=2026-04-04", "flight_date=2026-05-01"}
    after = {name: set(house.table(name).folders) for name in before}
    for name in (upkeep.FACT, upkeep.SALES):
        assert {f.partition("/")[2] for f in after[name] - before[name]} == {"flight_date=2026-04-04", "flight_date=2026-05-01"}
    assert len(after[upkeep.CUSTOMERS] - before[upkeep.CUSTOMERS]) <= 3
    same_as_full(house, bookings(spark, rows))
    assert upkeep.refresh_bookings(house, bookings(spark, rows), label="day 3") == 0


def test_only_versions_near_the_mark_are_read(spark, house):
    old = [(f"b{n}", "2026-03-20 00:00:00", "c", 1, 10.0, "CONFIRMED", n) for n in range(5)]
    upkeep.refresh_bookings(house, bookings(spark, old))
    raw = bookings(spark, [("late", "2026-03-18 00:00:00", "c", 1, 5.0, "CONFIRMED", 50), ("too-late", "2026-03-10 00:00:00", "c", 1, 5.0, "CONFIRMED", 51)])
    assert upkeep.refresh_bookings(house, raw, "3 days") == 1
    assert {r.booking_id for r in house.read(upkeep.FACT).collect()} == {"B0", "B1", "B2", "B3", "B4", "LATE"}
    assert house.read(upkeep.MARKS).first().updated_at.day == 20
