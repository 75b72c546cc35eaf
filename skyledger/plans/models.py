"""Dimensions, facts and intermediates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import calendar, flag, floor_at
from ..operators.dedupe import keep_first
from ..operators.incremental import delete_insert

DELAYED_FROM = 15  # minutes
HIGH_VALUE_FROM = 2500  # confirmed spend of a customer


def confirmed_price() -> Column:
    """Ticket price of a confirmed booking, zero for any other."""
    return F.when(F.col("booking_status") == "CONFIRMED", F.col("ticket_price")).otherwise(0)


def refunded_price() -> Column:
    return F.when(F.col("is_refunded"), F.col("ticket_price")).otherwise(0)


def row_count() -> Column:
    return F.count(F.lit(1))


def dim_airport(stg_airports: DataFrame) -> DataFrame:
    """One airport per code: with scheduled service before without, then by ident."""
    unscheduled = F.coalesce(F.col("scheduled_service") != "yes", F.lit(True))
    best = keep_first(stg_airports, ["airport_code"], [unscheduled.asc(), F.col("ident").asc_nulls_last()])
    return best.drop("loaded_at")


def dim_airline(stg_flights: DataFrame) -> DataFrame:
    codes = stg_flights.select("airline").dropna().distinct()
    return codes.withColumn("airline_code", F.col("airline"))


def dim_route(stg_flights: DataFrame) -> DataFrame:
    return stg_flights.groupBy("route", "origin_airport", "destination_airport").agg(
        F.avg("distance_miles").alias("avg_distance_miles"),
        row_count().alias("observed_flight_count"),
    )


def dim_customer(stg_bookings: DataFrame) -> DataFrame:
    """Customers with their bookings; the segment kept is the last one by name."""
    return stg_bookings.groupBy("customer_id").agg(
        F.min("booking_time").alias("first_booking_time"),
        F.max("booking_time").alias("latest_booking_time"),
        row_count().alias("lifetime_booking_count"),
        F.sum(confirmed_price()).alias("lifetime_confirmed_revenue"),
        F.max("customer_segment").alias("latest_customer_segment"),
    )


def dim_date(stg_flights: DataFrame, stg_bookings: DataFrame) -> DataFrame:
    """Every date of a flight or booking with its calendar parts."""
    days = stg_flights.select("flight_date").distinct().union(stg_bookings.select("flight_date").distinct())
    days = days.dropna().distinct().withColumnRenamed("flight_date", "date_day")
    return days.select("date_day", *calendar("date_day"))


def fact_flight_status(stg_flights: DataFrame) -> DataFrame:
    worst = floor_at("dep_delay_minutes", F.col("arr_delay_minutes"))
    return stg_flights.select(
        "flight_id",
        "flight_date",
        "airline",
        "origin_airport",
        "destination_airport",
        "route",
        "distance_miles",
        "dep_delay_minutes",
        "arr_delay_minutes",
        worst.alias("delay_minutes"),
        flag(worst, ">=", DELAYED_FROM).alias("is_delayed"),
        flag("cancelled", "=", 1).alias("is_cancelled"),
        flag("diverted", "=", 1).alias("is_diverted"),
        "cancellation_code",
        "carrier_delay",
        "weather_delay",
        "nas_delay",
        "security_delay",
        "late_aircraft_delay",
    )


def fact_booking(stg_bookings: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """The booking fact; with an existing table, its state after the incremental run."""
    new = stg_bookings.drop("loaded_at")
    return new if existing is None else delete_insert(existing, new, "flight_date", ["booking_id"])


def fact_payment(stg_payments: DataFrame) -> DataFrame:
    return stg_payments.drop("loaded_at")


def int_route_daily(fact_flight_status: DataFrame) -> DataFrame:
    return fact_flight_status.groupBy("flight_date", "route", "origin_airport", "destination_airport").agg(
        row_count().alias("flight_count"),
        F.avg("delay_minutes").alias("avg_delay_minutes"),
        F.count_if("is_delayed").alias("delayed_flight_count"),
        F.count_if("is_cancelled").alias("cancelled_flight_count"),
    )


def int_flight_booking_bridge(fact_booking: DataFrame) -> DataFrame:
    return fact_booking.groupBy("flight_id", "route", "flight_date").agg(
        row_count().alias("booking_count"),
        F.count_if(F.col("booking_status") == "CONFIRMED").alias("confirmed_booking_count"),
        F.sum(confirmed_price()).alias("confirmed_revenue"),
        F.sum(refunded_price()).alias("refund_amount"),
    )


def int_customer_booking(fact_booking: DataFrame) -> DataFrame:
    spend = fact_booking.groupBy("customer_id").agg(
        row_count().alias("booking_count"),
        F.sum(confirmed_price()).alias("total_spend"),
        F.max("booking_time").alias("latest_booking_time"),
        F.min("booking_time").alias("first_booking_time"),
    )
    return with_lifecycle(spend)


def with_lifecycle(spend: DataFrame) -> DataFrame:
    segment = (
        F.when(F.col("booking_count") == 1, "NEW")
        .when(F.col("total_spend") >= HIGH_VALUE_FROM, "HIGH_VALUE")
        .otherwise("RETURNING")
    )
    return spend.withColumn("lifecycle_segment", segment)
