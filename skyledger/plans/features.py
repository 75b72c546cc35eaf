"""Route features straight from the source files, and the audit row of the job that writes them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import abs_value, clip, map_vocab, route_ws, strip_terminal_feature, try_number
from ..functions.vocab import BOOKING_STATUS_FEATURE
from ..operators.audit import counted
from ..schemas import JOB_AUDIT

JOB_NAME = "route_feature_job"


def feat_route_delay(flights: DataFrame) -> DataFrame:
    """Counts, delays and causes by route and airline; flights without a date are left out."""
    measures = {
        "DepDelayMinutes": "dep_delay", "ArrDelayMinutes": "arr_delay", "Distance": "distance",
        "Cancelled": "cancelled", "Diverted": "diverted", "CarrierDelay": "carrier", "WeatherDelay": "weather",
        "NASDelay": "nas", "SecurityDelay": "security", "LateAircraftDelay": "late_aircraft",
    }
    rows = flights.where(F.col("FlightDate").isNotNull()).select(
        route_ws(strip_terminal_feature("Origin"), strip_terminal_feature("Dest")).alias("route"),
        strip_terminal_feature("Reporting_Airline").alias("airline"),
        *[F.col(source).try_cast("double").alias(name) for source, name in measures.items()],
    )
    causes = ["carrier", "weather", "nas", "security", "late_aircraft"]
    return rows.groupBy("route", "airline").agg(
        F.count(F.lit(1)).alias("flight_count"),
        F.count_if(F.col("cancelled") == 1).alias("cancelled_count"),
        F.count_if(F.col("diverted") == 1).alias("diverted_count"),
        F.avg("dep_delay").alias("avg_dep_delay_minutes"),
        F.avg("arr_delay").alias("avg_arr_delay_minutes"),
        F.percentile_approx("arr_delay", 0.95).alias("p95_arr_delay_minutes"),
        F.avg("distance").alias("avg_distance_miles"),
        *[F.sum(F.coalesce(name, F.lit(0.0))).alias(f"{name}_delay_minutes") for name in causes],
    )


def feat_route_booking(bookings: DataFrame) -> DataFrame:
    """Booking events by route, with repeats; a route here keeps lower-case or padded terminals."""
    status = map_vocab(F.upper(F.trim("booking_status")), BOOKING_STATUS_FEATURE)
    channel = F.upper(F.replace(F.trim("booking_channel"), F.lit(" "), F.lit("_")))
    rows = bookings.select(
        route_ws(strip_terminal_feature("origin_airport"), strip_terminal_feature("destination_airport")).alias(
            "route"
        ),
        status.alias("status"),
        channel.alias("channel"),
        F.nullif("customer_id", F.lit("")).alias("customer"),
        abs_value(try_number("ticket_price")).alias("price"),
    )

    def events(column: str, value: str) -> Column:
        return F.count_if(F.col(column) == value)

    return rows.groupBy("route").agg(
        F.count(F.lit(1)).alias("booking_event_count"),
        events("status", "CONFIRMED").alias("confirmed_booking_events"),
        events("status", "CANCELLED").alias("cancelled_booking_events"),
        events("status", "PENDING").alias("pending_booking_events"),
        F.count_distinct("customer").alias("distinct_customers"),
        F.sum("price").alias("total_ticket_value"),
        F.avg("price").alias("avg_ticket_price"),
        events("channel", "WEB").alias("web_booking_events"),
        events("channel", "MOBILE_APP").alias("mobile_booking_events"),
        events("channel", "AGENCY").alias("agency_booking_events"),
        events("channel", "CALL_CENTER").alias("call_center_booking_events"),
    )


COUNTS = ["source_flight_rows", "source_booking_rows", "output_route_delay_rows", "output_route_booking_rows"]


def feat_job_audit(
    spark: SparkSession,
    run_id: str,
    counts: dict[str, int],
    status: str,
    error: str | None = None,
    started_at=None,
    completed_at=None,
) -> DataFrame:
    """The audit row of one job run; missing counts are zero, a long error is cut."""
    values = [run_id, JOB_NAME, *[counts.get(name, 0) for name in COUNTS], status, started_at, completed_at, error]
    row = spark.createDataFrame([tuple(values)], JOB_AUDIT)
    return row.withColumn("error_message", clip("error_message", 2000))


def run_feature_job(
    spark: SparkSession, flights: DataFrame, bookings: DataFrame, run_id: str, write
) -> DataFrame:
    """Write both feature tables with ``write(df, name)`` and return the audit row.

    Each source is read once: rows are counted while the tables are written.
    """
    from datetime import datetime

    started, counts = datetime.now(), {}
    status, error = "SUCCESS", None
    try:
        for source, feature, name in (
            (flights, feat_route_delay, "route_delay"),
            (bookings, feat_route_booking, "route_booking"),
        ):
            rows_in, seen_in = counted(source)
            rows_out, seen_out = counted(feature(rows_in))
            write(rows_out.withColumn("spark_processed_at", F.current_timestamp()), f"spark_{name}_features")
            counts[f"source_{'flight' if name == 'route_delay' else 'booking'}_rows"] = seen_in.get["rows"]
            counts[f"output_{name}_rows"] = seen_out.get["rows"]
    except Exception as failure:  # the audit row records the failure, then the caller sees it
        status, error = "FAILED", str(failure)
        audit = feat_job_audit(spark, run_id, counts, status, error, started, datetime.now())
        write(audit, "spark_job_audit")
        raise
    audit = feat_job_audit(spark, run_id, counts, status, error, started, datetime.now())
    write(audit, "spark_job_audit")
    return audit
