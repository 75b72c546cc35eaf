"""Report queries and dashboard panels over the finished tables.

A report with a row limit has a total order, so it returns the same rows on every run.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import json_text
from ..operators.assertions import as_relationships
from ..operators.filters import latest_run


def _top(df: DataFrame, order: list[Column], limit: int) -> DataFrame:
    return df.orderBy(*order).limit(limit)


def _down(name: str) -> Column:
    return F.col(name).desc_nulls_last()


def table_counts(tables: dict[str, DataFrame], name_col: str) -> DataFrame:
    """One row per table with its number of rows."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias(name_col), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def rq_latest_reconciliation(reconciliation: DataFrame) -> DataFrame:
    return (
        latest_run(reconciliation, "run_id", "created_at")
        .select(
            "source_name", "source_file_rows", "quarantined_rows", "expected_raw_rows", "actual_raw_rows",
            "difference", "status",
        )
        .orderBy("source_name")
    )


def rq_dq_by_rule(dq_errors: DataFrame) -> DataFrame:
    counts = dq_errors.groupBy("severity", "rule_name").agg(F.count(F.lit(1)).alias("record_count"))
    return counts.orderBy(_down("record_count"), "severity", "rule_name")


def rq_recent_quarantine(quarantine: DataFrame) -> DataFrame:
    return _top(quarantine, [_down("created_at"), F.col("quarantine_id")], 10).select(
        "created_at", "run_id", "source_name", "record_key", "reason", "raw_record"
    )


def rq_load_audit(load_audit: DataFrame) -> DataFrame:
    order = [_down("completed_at"), F.col("source_name"), F.col("load_audit_id")]
    return _top(load_audit, order, 20).select(
        "source_name", "target_table", "checksum_md5", "source_rows", "valid_rows", "quarantined_rows",
        "inserted_rows", "skipped_rows", "load_status", "completed_at",
    )


def rq_fact_counts(facts: dict[str, DataFrame]) -> DataFrame:
    return table_counts(facts, "table_name")


def rq_top_routes(mart_route_performance: DataFrame) -> DataFrame:
    return _top(mart_route_performance, [_down("revenue"), F.col("route")], 20).select(
        "route", "booking_count", "revenue", "avg_delay_minutes", "delayed_rate", "cancellation_rate"
    )


def rq_daily_sales(mart_sales_performance: DataFrame) -> DataFrame:
    days = mart_sales_performance.groupBy("flight_date").agg(
        F.sum("booking_count").alias("bookings"),
        F.sum("revenue").alias("revenue"),
        F.sum("refund_amount").alias("refund_amount"),
        F.sum("failed_payment_count").alias("failed_payment_count"),
    )
    return _top(days, [F.col("flight_date")], 60)


def rq_channel_trend(mart_booking_trend_daily: DataFrame) -> DataFrame:
    days = mart_booking_trend_daily.groupBy("booking_date", "booking_channel").agg(
        F.sum("booking_count").alias("bookings"),
        F.sum("confirmed_revenue").alias("confirmed_revenue"),
        F.sum("cancelled_count").alias("cancelled_count"),
    )
    return _top(days, [F.col("booking_date"), F.col("booking_channel")], 80)


def rq_lifecycle(mart_customer_segment: DataFrame) -> DataFrame:
    return mart_customer_segment.orderBy(_down("total_spend"), "lifecycle_segment")


def rq_airports(mart_airport_performance: DataFrame) -> DataFrame:
    return _top(mart_airport_performance, [_down("delay_count"), F.col("airport_code")], 25).select(
        "airport_code", "airport_name", "iso_region", "origin_volume", "destination_volume", "delay_count",
        "cancelled_count",
    )


def rq_delay_drivers(mart_flight_delay_analysis: DataFrame) -> DataFrame:
    order = [_down("avg_delay_minutes"), F.col("flight_date"), F.col("airline"), F.col("route")]
    return _top(mart_flight_delay_analysis, order, 25).select(
        "flight_date", "airline", "route", "flight_count", "avg_delay_minutes", "delayed_rate",
        "carrier_delay_minutes", "weather_delay_minutes", "nas_delay_minutes", "late_aircraft_delay_minutes",
    )


def rq_orphans(fact_payment: DataFrame, fact_booking: DataFrame) -> DataFrame:
    """Payments without a booking; a payment without a booking id counts as one."""
    orphans = as_relationships(fact_payment, "booking_id", fact_booking, "booking_id").select("n")
    unnamed = fact_payment.where(F.col("booking_id").isNull()).agg(F.count(F.lit(1)).alias("n"))
    return orphans.unionByName(unnamed).agg(F.sum("n").alias("orphan_payment_count"))


def rq_stream_counts(stream_tables: dict[str, DataFrame]) -> DataFrame:
    return table_counts(stream_tables, "object_name")


def rq_stream_reconciliation(stream_reconciliation: DataFrame) -> DataFrame:
    order = [_down("created_at"), F.col("run_id"), F.col("topic_name")]
    return _top(stream_reconciliation, order, 10).select(
        "run_id", "topic_name", "produced_events", "consumed_events", "duplicate_events", "dlq_events",
        "difference", "status", "created_at",
    )


def rq_stream_recent(booking_events: DataFrame, fields: tuple[str, ...] = ("booking_status", "route")) -> DataFrame:
    newest = _top(booking_events, [_down("ingested_at"), _down("kafka_offset"), F.col("event_id")], 10)
    return newest.select(
        "event_time", "event_type", "entity_key", "kafka_topic", "kafka_partition", "kafka_offset",
        *[json_text("payload", f"$.{name}").alias(name) for name in fields],
    )


def rq_job_audit(job_audit: DataFrame) -> DataFrame:
    return _top(job_audit, [_down("completed_at"), F.col("job_run_id")], 10).select(
        "job_name", "status", "source_flight_rows", "source_booking_rows", "output_route_delay_rows",
        "output_route_booking_rows", "started_at", "completed_at", "error_message",
    )


def rq_top_delay_features(feat_route_delay: DataFrame) -> DataFrame:
    order = [_down("p95_arr_delay_minutes"), F.col("route"), F.col("airline")]
    return _top(feat_route_delay, order, 20).select(
        "route", "airline", "flight_count", "cancelled_count", "avg_arr_delay_minutes", "p95_arr_delay_minutes",
        "carrier_delay_minutes", "weather_delay_minutes", "nas_delay_minutes", "late_aircraft_delay_minutes",
    )


def rq_top_booking_features(feat_route_booking: DataFrame) -> DataFrame:
    return _top(feat_route_booking, [_down("total_ticket_value"), F.col("route")], 20).select(
        "route", "booking_event_count", "confirmed_booking_events", "cancelled_booking_events",
        "distinct_customers", "total_ticket_value", "avg_ticket_price", "web_booking_events",
        "mobile_booking_events",
    )


def rq_quarantine_by_reason(quarantine: DataFrame) -> DataFrame:
    counts = quarantine.groupBy("source_name", "reason").agg(F.count(F.lit(1)).alias("record_count"))
    return counts.orderBy(_down("record_count"), "source_name", "reason")


# Dashboard panels -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Panel:
    """A panel aggregates one table by some columns, or lists columns of it.

    A metric is ``count`` or ``<function>__<column>``, as ``auto_metrics`` names them.
    """

    table: str
    group_by: tuple[str, ...] = ()
    metrics: tuple[str, ...] = ()
    columns: tuple[str, ...] = ()
    newest_by: str | None = None
    tie_break: tuple[str, ...] = ()
    limit: int | None = None
    by_metric: bool = field(default=True)  # largest first metric first, else by the grouped columns


# What each panel shows.
PANELS = {
    "bi_total_revenue": Panel("mart_sales_performance", metrics=("sum__revenue",)),
    "bi_total_bookings": Panel("mart_sales_performance", metrics=("sum__booking_count",)),
    "bi_avg_ticket": Panel("mart_sales_performance", metrics=("avg__average_ticket_value",)),
    "bi_quarantined": Panel("quarantine", metrics=("count",)),
    "bi_top_routes": Panel("mart_route_performance", ("route",), ("sum__revenue",), limit=10),
    "bi_booking_trend": Panel(
        "mart_booking_trend_daily",
        ("booking_date", "booking_channel"),
        ("sum__booking_count", "sum__confirmed_revenue"),
        limit=5000,
        by_metric=False,
    ),
    "bi_status_mix": Panel("mart_booking_status_realtime", ("booking_status",), ("sum__booking_count",), limit=20),
    "bi_delay_by_airline": Panel(
        "mart_flight_delay_analysis", ("airline",), ("avg__avg_delay_minutes", "avg__delayed_rate"), limit=15
    ),
    "bi_dq_by_rule": Panel("dq_errors", ("rule_name", "severity"), ("count",), limit=20),
    "bi_reconciliation": Panel(
        "reconciliation",
        ("run_id", "source_name", "target_table", "status"),
        (
            "sum__source_file_rows", "sum__quarantined_rows", "sum__expected_raw_rows", "sum__actual_raw_rows",
            "sum__difference",
        ),
        limit=1000,
    ),
    "bi_quarantine_detail": Panel(
        "quarantine",
        columns=("created_at", "run_id", "source_name", "record_key", "reason", "file_path"),
        newest_by="created_at",
        tie_break=("quarantine_id",),
        limit=1000,
    ),
}


def metric(name: str) -> Column:
    function, _, column = name.partition("__")
    if function == "count":
        return F.count(F.lit(1)).alias(name)
    return {"sum": F.sum, "avg": F.avg}[function](column).alias(name)


def auto_metrics(df: DataFrame) -> list[Column]:
    """``count``, and sum and average of every numeric column."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    return [metric("count")] + [metric(f"{function}__{name}") for name in numeric for function in ("sum", "avg")]


def bi_auto_metrics(df: DataFrame) -> DataFrame:
    return df.agg(*auto_metrics(df))


def bi_run_panel(tables, spec: Panel) -> DataFrame:
    """Evaluate a panel; ``tables`` maps a table name to its DataFrame."""
    df = tables[spec.table]
    if spec.columns:
        order = [_down(spec.newest_by), *[F.col(name) for name in spec.tie_break]]
        return _top(df, order, spec.limit).select(*spec.columns)
    measures = [metric(name) for name in spec.metrics]
    out = df.groupBy(*spec.group_by).agg(*measures) if spec.group_by else df.agg(*measures)
    if spec.limit is None:
        return out
    groups = [F.col(name) for name in spec.group_by]
    return _top(out, [_down(spec.metrics[0]), *groups] if spec.by_metric else groups, spec.limit)
