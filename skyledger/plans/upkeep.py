"""Upkeep of the booking tables of a warehouse: a run reads and writes only what its new versions change.

* *High-water mark.* Of the raw rows those are read whose ``updated_at`` is not below the stored maximum less an allowance
  for late versions; one without a time sorts above every value and is always read.
* *Current versions* lie in buckets by booking. New versions are compared with the current ones of their buckets by the
  order of the staging model, where an equal one changes nothing, so late, equal and repeated versions give what a full
  run gives.
* *Changed keys* flow on: a booking that got a new version touches its old and its new flight date, and its old and its new
  customer on that date. The fact and the sales mart are replaced for these dates, the days of customers for these pairs
  of customer and date, and the tables by customer for these customers, from their days and not from their bookings.

All tables and the mark are committed together (``sources.versions``); a label makes a rerun change nothing. Versions that
come later than the allowance are not seen. Only the touched dates come to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.dedupe import keep_latest
from ..sources.tables import written
from ..sources.versions import Transaction, Warehouse
from . import marts, models, staging

VERSIONS, FACT, CUSTOMER_DAYS = "state/booking_versions", "fact/fact_booking", "state/customer_days"
SALES, CUSTOMERS, CUSTOMER_BOOKINGS = "mart/mart_sales_performance", "dim/dim_customer", "int/int_customer_booking"
MARKS, MARK_SCHEMA = "metadata/high_water", "source string, updated_at timestamp_ntz"
BUCKETS = 64
_PAIR = ["customer_id", "flight_date"]


def above_mark(raw: DataFrame, mark: str | None, lateness: str) -> DataFrame:
    """Raw versions at or above the mark less the allowance, in plain comparisons that reach the scan."""
    if mark is None:
        return raw
    limit = F.lit(mark).cast("timestamp_ntz") - F.expr(f"interval {lateness}")
    # staging lifts a time to that of creation
    return raw.where(F.col("updated_at").isNull() | (F.col("updated_at") >= limit) | (F.col("created_at") >= limit))


def _later(order: list[str]) -> Column:
    """Whether a version is later than the current one (``_old_`` columns); NULL is above every value, an equal one is not later."""
    later = F.lit(False)
    for c in reversed(order):
        new, old = F.col(c), F.col(f"_old_{c}")
        known = F.when(old.isNull(), False).when(new.isNull() | (new > old), True).otherwise(False)
        later = F.when(new.eqNullSafe(old), later).otherwise(known)
    return later


def _changed(change: Transaction, fresh: DataFrame) -> DataFrame:
    """New current versions, with the date and customer of the one they replace.

    Both sides have one row per booking, so one join with the narrow columns of the current ones settles it.
    """
    current = change.read_keys(VERSIONS, fresh)
    olds = [F.col(c).alias(f"_old_{c}") for c in staging.VERSION_ORDER]
    old = current.select("booking_id", F.col("flight_date").alias("_old_date"), F.col("customer_id").alias("_old_customer"), *olds, F.lit(True).alias("_known"))
    both = fresh.join(old, "booking_id", "left").where(F.col("_known").isNull() | _later(staging.VERSION_ORDER))
    return written(both.select(*fresh.columns, "_old_date", "_old_customer", "_known"), "changed-bookings")


def customer_days(fact_booking: DataFrame) -> DataFrame:
    """What a customer's bookings of one flight date add to the tables by customer."""
    return fact_booking.groupBy(*_PAIR).agg(
        models.row_count().alias("bookings"),
        F.sum(models.confirmed_price()).cast("decimal(38,2)").alias("spend"),
        F.min("booking_time").alias("first_time"),
        F.max("booking_time").alias("latest_time"),
        F.max("customer_segment").alias("segment"),
    )


def _of_customers(days: DataFrame) -> DataFrame:
    return days.groupBy("customer_id").agg(
        F.sum("bookings").alias("bookings"), F.sum("spend").alias("spend"), F.min("first_time").alias("first_time"),
        F.max("latest_time").alias("latest_time"), F.max("segment").alias("segment"),
    )


def _as(df: DataFrame, like: DataFrame) -> DataFrame:
    """Columns in the types of another plan."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in like.schema])


def refresh_bookings(
    house: Warehouse, raw_bookings: DataFrame, lateness: str = "3 days", label: str | None = None, buckets: int = BUCKETS
) -> int:
    """Bring fact, sales mart and the tables by customer up to the raw bookings; the number of versions that were new.

    ``buckets`` is fixed by the first run.
    """
    if label is not None and house.holds(label):
        return 0
    change, spark = house.begin(), house.spark
    mark = None if change.table(MARKS) is None else change.read(MARKS).where("source = 'bookings'").agg(F.max("updated_at").cast("string")).first()[0]
    clean = staging.booking_versions(above_mark(raw_bookings, mark, lateness))
    fresh = written(keep_latest(clean, ["booking_id"], staging.VERSION_ORDER), "fresh-bookings")
    plain = staging.current_bookings(fresh).drop("loaded_at")
    if change.table(VERSIONS) is None:
        change.create(VERSIONS, fresh.schema, ["booking_id"], buckets)
        change.create(CUSTOMER_DAYS, customer_days(plain).schema, ["customer_id"], buckets)
        change.create(CUSTOMERS, models.dim_customer(plain).schema, ["customer_id"], buckets)
        change.create(CUSTOMER_BOOKINGS, models.int_customer_booking(plain).schema, ["customer_id"], buckets)
        change.replace(FACT, plain.limit(0), ["flight_date"])
        change.replace(SALES, marts.mart_sales_performance(plain.limit(0)), ["flight_date"])
    changed = _changed(change, fresh)
    count = changed.count()
    change.merge(VERSIONS, changed.select(*fresh.columns), [c for c in fresh.columns if c != "booking_id"])

    gone = changed.where("_known").select(F.col("_old_customer").alias("customer_id"), F.col("_old_date").alias("flight_date"))
    pairs = written(gone.unionByName(changed.select(*_PAIR)).distinct(), "customer-days")
    dates = [r[0] for r in pairs.select("flight_date").distinct().select(F.col("flight_date").cast("string")).collect()]

    kept = change.read_parts(FACT, dates).join(changed.select("booking_id"), "booking_id", "left_anti")
    new = staging.current_bookings(changed.select(*fresh.columns)).drop("loaded_at")
    change.replace_parts(FACT, kept.select(*new.columns).unionByName(new), "flight_date", dates)
    fact = change.read_parts(FACT, dates)
    change.replace_parts(SALES, marts.mart_sales_performance(fact), "flight_date", dates)

    touched = fact.join(pairs, [fact[c].eqNullSafe(pairs[c]) for c in _PAIR], "left_semi")
    change.replace_keys(CUSTOMER_DAYS, pairs, customer_days(touched))
    who = pairs.select("customer_id").distinct()
    sums = _of_customers(change.read_keys(CUSTOMER_DAYS, who).join(who, "customer_id", "left_semi"))
    customers = sums.selectExpr(
        "customer_id", "first_time as first_booking_time", "latest_time as latest_booking_time", "bookings as lifetime_booking_count",
        "spend as lifetime_confirmed_revenue", "segment as latest_customer_segment",
    )
    bookings = models.with_lifecycle(
        sums.selectExpr("customer_id", "bookings as booking_count", "spend as total_spend", "latest_time as latest_booking_time", "first_time as first_booking_time")
    )
    change.replace_keys(CUSTOMERS, who, _as(customers, models.dim_customer(plain)))
    change.replace_keys(CUSTOMER_BOOKINGS, who, _as(bookings, models.int_customer_booking(plain)))

    latest = fresh.agg(F.max("updated_at").cast("timestamp_ntz").alias("updated_at")).select(F.lit("bookings").alias("source"), F.greatest("updated_at", F.lit(mark).cast("timestamp_ntz")).alias("updated_at"))
    change.replace(MARKS, latest)
    change.commit(label)
    return count
