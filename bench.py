"""Time the headline queries on one folder of tables and print one JSON line.

``BENCH_SF_DIR`` names the folder and ``BENCH_CPUS`` the number of local threads. Deriving and landing the
source tables is timed on its own as ``land_sources`` and is part of the total. Every query is run once on
each warm-up and measured on the second run, from the given Parquet files or the landed sources to the last
row of its result. ``BENCH_QUERIES`` (comma-separated) picks other queries; ``all`` runs every one.
"""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = [
    "stg_flights", "stg_airports", "stg_bookings", "stg_payments", "cdc_keep_latest",
    "dim_airport", "dim_airline", "dim_route", "dim_customer", "dim_date",
    "fact_flight_status", "fact_booking", "fact_booking_incremental", "fact_payment",
    "int_route_daily", "int_flight_booking_bridge", "int_customer_booking",
    "mart_sales_performance", "mart_booking_status_realtime", "mart_booking_trend_daily", "mart_route_performance",
    "mart_airport_performance", "mart_customer_segment", "mart_flight_delay_analysis",
    "feat_route_delay", "feat_route_booking",
    "dq_error_log", "dq_split_valid_invalid", "dq_duplicate_event", "dq_relationship_missing",
    "dq_profile_bookings", "dq_profile_payments", "dq_report", "dq_persist_errors", "dq_persist_quarantine",
    "ld_checksum_skip", "ld_audit", "ld_slice_replace", "up_do_update", "up_do_nothing", "inc_delete_insert",
    "rc_source_to_raw", "as_unique", "as_relationships", "as_suite", "ld_load_files", "rq_top_routes", "rq_orphans", "rq_stream_counts",
    "src_csv_records", "src_row_number", "src_file_profile", "sink_table", "sink_stream_messages", "st_build_envelope", "st_validate_envelope", "st_idempotent_land",
    "inj_duplicate",
]


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from skyledger.checks import QUERIES
    from skyledger.checks.fixtures import Tables
    from skyledger.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE

    seconds: dict[str, float] = {}
    started = time.perf_counter()
    tables = Tables(spark, sf_dir)
    for name in ("bookings", "payments", "flights", "messages", "raw_flights", "raw_bookings", "raw_payments"):
        tables[name]
    seconds["land_sources"] = round(time.perf_counter() - started, 3)
    for name in names:
        for _ in range(2):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - started, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_query_time", "value": total, "unit": "sec", "queries": seconds, "sf": sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
