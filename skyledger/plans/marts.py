"""The seven reporting marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import date_trunc_cast, extract_hour, ratio
from ..operators.filters import rows_in
from .models import confirmed_price, refunded_price, row_count


def mart_sales_performance(fact_booking: DataFrame) -> DataFrame:
    return fact_booking.groupBy("flight_date", "airline", "route").agg(
        row_count().alias("booking_count"),
        F.sum(confirmed_price()).alias("revenue"),
        F.avg("ticket_price").alias("average_ticket_value"),
        F.sum(refunded_price()).alias("refund_amount"),
        F.count_if(F.col("payment_status") == "FAILED").alias("failed_payment_count"),
    )


def mart_booking_status_realtime(fact_booking: DataFrame) -> DataFrame:
    return fact_booking.groupBy("booking_status", "payment_status").agg(
        row_count().alias("booking_count"),
        F.max("updated_at").alias("latest_update_time"),
        F.sum("ticket_price").alias("gross_ticket_value"),
    )


def mart_booking_trend_daily(
    fact_booking: DataFrame, stg_bookings: DataFrame | None = None, existing: DataFrame | None = None
) -> DataFrame:
    """Bookings by day, hour and channel; with an existing table, its state after the incremental run.

    That run first drops every day on which a staged booking was made.
    """
    trend = fact_booking.groupBy(
        date_trunc_cast("booking_time").alias("booking_date"),
        extract_hour("booking_time").alias("booking_hour"),
        "booking_channel",
    ).agg(
        row_count().alias("booking_count"),
        F.sum(confirmed_price()).alias("confirmed_revenue"),
        F.count_if(F.col("booking_status") == "CANCELLED").alias("cancelled_count"),
    )
    if existing is None:
        return trend
    if stg_bookings is not None:
        staged = stg_bookings.select(date_trunc_cast("booking_time").alias("booking_date"))
        existing = rows_in(existing, staged, "booking_date", anti=True)
    keys = ["booking_date", "booking_hour", "booking_channel"]
    replaced = existing.join(trend.select(*keys), keys, "left_anti").select(*trend.columns)
    return replaced.unionByName(trend)


def mart_route_performance(int_route_daily: DataFrame, int_flight_booking_bridge: DataFrame) -> DataFrame:
    """Bookings, delays and rates by route.

    A day of a route counts once per booked flight of that day (once when there is none), as the
    left join of the two grains has it. The bookings are summed per route and day before the join
    and that multiplicity is carried as a weight, so the join is one to one and never fans out.
    """
    booked = int_flight_booking_bridge.groupBy("route", "flight_date").agg(
        F.sum("booking_count").alias("booking_count"),
        F.sum("confirmed_revenue").alias("revenue"),
        row_count().alias("flights_booked"),
    )
    return _by_route(int_route_daily, booked, F.coalesce("flights_booked", F.lit(1)))


def mart_route_performance_grain_safe(int_route_daily: DataFrame, int_flight_booking_bridge: DataFrame) -> DataFrame:
    """The same report with every day of a route counted once."""
    booked = int_flight_booking_bridge.groupBy("route", "flight_date").agg(
        F.sum("booking_count").alias("booking_count"),
        F.sum("confirmed_revenue").alias("revenue"),
    )
    return _by_route(int_route_daily, booked, F.lit(1))


def _by_route(days: DataFrame, booked: DataFrame, weight) -> DataFrame:
    joined = days.join(booked, ["route", "flight_date"], "left").withColumn("weight", weight)
    flights = F.sum(F.col("flight_count") * F.col("weight"))
    days_weighted = F.when(F.col("avg_delay_minutes").isNotNull(), F.col("weight"))
    return joined.groupBy("route", "origin_airport", "destination_airport").agg(
        F.sum(F.coalesce("booking_count", F.lit(0))).alias("booking_count"),
        F.sum(F.coalesce("revenue", F.lit(0))).alias("revenue"),
        ratio(F.sum(F.col("avg_delay_minutes") * F.col("weight")), F.sum(days_weighted)).alias("avg_delay_minutes"),
        ratio(F.sum(F.col("delayed_flight_count") * F.col("weight")), flights).alias("delayed_rate"),
        ratio(F.sum(F.col("cancelled_flight_count") * F.col("weight")), flights).alias("cancellation_rate"),
    )


def mart_airport_performance(fact_flight_status: DataFrame, dim_airport: DataFrame) -> DataFrame:
    """Departures, arrivals, delays and cancellations by airport.

    Flights are counted per origin and destination first, so only airport rows are joined.
    """
    flights = fact_flight_status.groupBy("origin_airport", "destination_airport").agg(
        row_count().alias("flights"),
        F.count_if("is_delayed").alias("delayed"),
        F.count_if("is_cancelled").alias("cancelled"),
    )
    ends = flights.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("origin_airport").alias("airport_code"),
                    F.col("flights").alias("departures"),
                    F.lit(0).cast("bigint").alias("arrivals"),
                ),
                F.struct(
                    F.col("destination_airport").alias("airport_code"),
                    F.lit(0).cast("bigint").alias("departures"),
                    F.col("flights").alias("arrivals"),
                ),
            )
        ),
        "delayed",
        "cancelled",
    )
    volumes = ends.groupBy("airport_code").agg(
        F.sum("departures").alias("origin_volume"),
        F.sum("arrivals").alias("destination_volume"),
        F.sum("delayed").alias("delay_count"),
        F.sum("cancelled").alias("cancelled_count"),
    )
    about = dim_airport.select("airport_code", "airport_name", "iso_country", "iso_region")
    return volumes.join(about, "airport_code", "left").select(
        "airport_code",
        "airport_name",
        "iso_country",
        "iso_region",
        "origin_volume",
        "destination_volume",
        "delay_count",
        "cancelled_count",
    )


def mart_customer_segment(int_customer_booking: DataFrame) -> DataFrame:
    return int_customer_booking.groupBy("lifecycle_segment").agg(
        row_count().alias("customer_count"),
        F.sum("booking_count").alias("booking_count"),
        F.sum("total_spend").alias("total_spend"),
        F.avg("total_spend").alias("avg_customer_spend"),
    )


def mart_flight_delay_analysis(fact_flight_status: DataFrame) -> DataFrame:
    causes = ["carrier_delay", "weather_delay", "nas_delay", "security_delay", "late_aircraft_delay"]
    return fact_flight_status.groupBy(
        "flight_date", "airline", "origin_airport", "destination_airport", "route"
    ).agg(
        row_count().alias("flight_count"),
        F.avg("delay_minutes").alias("avg_delay_minutes"),
        ratio(F.count_if("is_delayed"), row_count()).alias("delayed_rate"),
        F.count_if("is_cancelled").alias("cancelled_count"),
        *[F.sum(name).alias(f"{name}_minutes") for name in causes],
    )
