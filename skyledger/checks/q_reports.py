"""Report queries and dashboard panels."""

from __future__ import annotations

from ..plans import features, reports
from ..streaming.envelope import BOOKING_TOPIC
from ..streaming.reconcile import st_reconcile
from .fixtures import Tables
from .registry import register

register(
    "rq_latest_reconciliation",
    """select source_name, source_file_rows, quarantined_rows, expected_raw_rows, actual_raw_rows, difference, status from recon
where created_at=(select max(created_at) from recon)""",
)(lambda t: reports.rq_latest_reconciliation(t.reconciliation))
register("rq_dq_by_rule", "select severity, rule_name, count(*) as record_count from dq_stored group by 1,2")(
    lambda t: reports.rq_dq_by_rule(t.dq_errors)
)


@register(
    "rq_recent_quarantine",
    "select '2026-05-01 00:00:00' as created_at, run_id, source_name, record_key, reason from quarantined order by quarantine_id limit 10",
)
def _(t: Tables):
    return reports.rq_recent_quarantine(t.quarantine).drop("raw_record")


register(
    "rq_load_audit",
    """select source_name, target_table, checksum_md5, source_rows, valid_rows, quarantined_rows, inserted_rows, skipped_rows, load_status, completed_at
from audit_after order by audit_after.completed_at desc, source_name, load_audit_id limit 20""",
)(lambda t: reports.rq_load_audit(t.load_audit))
register(
    "rq_fact_counts",
    """select 'fact_booking' as table_name, count(*) as row_count from fact_b union all select 'fact_payment', count(*) from fact_p
union all select 'fact_flight_status', count(*) from fact_f""",
)(
    lambda t: reports.rq_fact_counts(
        {
            "fact_booking": t.fact_booking,
            "fact_payment": t.fact_payment,
            "fact_flight_status": t.fact_flight_status,
        }
    )
)
register(
    "rq_top_routes",
    """select route, booking_count, revenue::double as revenue, round(avg_delay_minutes,6) as avg_delay_minutes, round(delayed_rate,6) as delayed_rate,
 round(cancellation_rate,6) as cancellation_rate from m_route order by m_route.revenue desc, route limit 20""",
)(lambda t: reports.rq_top_routes(t.mart_route_performance))
register(
    "rq_daily_sales",
    """select flight_date::varchar as flight_date, sum(booking_count)::bigint as bookings, sum(revenue)::double as revenue,
 sum(refund_amount)::double as refund_amount, sum(failed_payment_count)::bigint as failed_payment_count from m_sales group by m_sales.flight_date order by 1 limit 60""",
)(lambda t: reports.rq_daily_sales(t.mart_sales_performance))
register(
    "rq_channel_trend",
    """select booking_date::varchar as booking_date, booking_channel, sum(booking_count)::bigint as bookings, sum(confirmed_revenue)::double as confirmed_revenue,
 sum(cancelled_count)::bigint as cancelled_count from m_trend group by m_trend.booking_date, booking_channel order by 1,2 limit 80""",
)(lambda t: reports.rq_channel_trend(t.mart_booking_trend_daily))
register(
    "rq_lifecycle",
    """select lifecycle_segment, customer_count, booking_count, total_spend::double as total_spend, round(avg_customer_spend,6) as avg_customer_spend
from m_segment""",
)(lambda t: reports.rq_lifecycle(t.mart_customer_segment))
register(
    "rq_airports",
    """select airport_code, airport_name, iso_region, origin_volume, destination_volume, delay_count, cancelled_count from m_airport
order by delay_count desc, airport_code limit 25""",
)(lambda t: reports.rq_airports(t.mart_airport_performance))


@register(
    "rq_delay_drivers",
    """select flight_date::varchar as flight_date, airline, route, flight_count, round(avg_delay_minutes,6) as avg_delay_minutes, round(delayed_rate,6) as delayed_rate,
 carrier_delay_minutes, weather_delay_minutes, nas_delay_minutes, late_aircraft_delay_minutes from m_delay
order by m_delay.avg_delay_minutes desc, m_delay.flight_date, airline, route limit 25""",
)
def _(t: Tables):
    return reports.rq_delay_drivers(t.mart_flight_delay_analysis)


register(
    "rq_orphans",
    "select count(*) as orphan_payment_count from fact_p p left join fact_b b on p.booking_id=b.booking_id where b.booking_id is null",
)(lambda t: reports.rq_orphans(t.fact_payment, t.fact_booking))
register("rq_stream_counts", "select * from stream_counts")(lambda t: reports.rq_stream_counts(t.stream_tables))

_STREAM_RECON = """select '{run}' as run_id, p.topic as topic_name, p.n as produced_events, coalesce(c.n,0) as consumed_events, {dup}::bigint as duplicate_events,
 (select count(*) from dlq) as dlq_events, p.n-coalesce(c.n,0) as difference,
 case when p.n-coalesce(c.n,0)<=(select count(*) from dlq)+{dup} then 'PASSED' else 'FAILED' end as status
from (select topic, count(*) as n from messages group by topic) p left join (select kafka_topic, count(*) as n from landed group by 1) c on p.topic=c.kafka_topic"""


def stream_reconciliation(t: Tables, run_id: str, duplicates: int, per_topic: bool = False):
    import functools

    from pyspark.sql import functions as F

    produced = t.messages.groupBy(F.col("topic").alias("topic_name")).agg(F.count(F.lit(1)).alias("produced_events"))
    columns = ["event_id", "kafka_topic"]
    tables = [df.select(*columns) for name, df in t.stream_tables.items() if name != "streaming_dlq"]
    landed = functools.reduce(lambda a, b: a.unionByName(b), tables)
    return st_reconcile(produced, landed, t.stream_tables["streaming_dlq"], run_id, duplicates, per_topic)


@register(
    "rq_stream_reconciliation",
    "select *, '2026-05-02 00:00:00' as created_at from ("
    + _STREAM_RECON.format(run="run-1", dup=0)
    + " union all "
    + _STREAM_RECON.format(run="run-2", dup=1000000)
    + ") z",
)
def _(t: Tables):
    from pyspark.sql import functions as F

    both = stream_reconciliation(t, "run-1", 0).unionByName(stream_reconciliation(t, "run-2", 1000000))
    stamped = both.withColumn("created_at", F.lit("2026-05-02 00:00:00").cast("timestamp"))
    return reports.rq_stream_reconciliation(stamped)


@register(
    "rq_stream_recent",
    """select event_time::varchar as event_time, event_type, entity_key, kafka_topic, kafka_partition, kafka_offset, payload_k as k, null::varchar as route
from landed where kafka_topic='booking_events' order by kafka_offset desc limit 10""",
)
def _(t: Tables):
    return reports.rq_stream_recent(t.stream_table(BOOKING_TOPIC), ("k", "route"))


@register(
    "rq_job_audit",
    """select * from (select 'route_feature_job' as job_name, 'SUCCESS' as status, (select count(*) from flights) as source_flight_rows,
 (select count(*) from bookings) as source_booking_rows, (select count(*) from f_delay) as output_route_delay_rows,
 (select count(*) from f_booking) as output_route_booking_rows, '2026-05-01 00:00:00' as started_at, '2026-05-01 00:05:00' as completed_at, null::varchar as error_message
 union all select 'route_feature_job', 'FAILED', (select count(*) from flights), 0, 0, 0, '2026-05-02 00:00:00', '2026-05-02 00:05:00', 'no bookings file') z""",
)
def _(t: Tables):
    from pyspark.sql import functions as F

    frames = dict(zip(features.COUNTS, (t.flights, t.bookings, t.feat_route_delay, t.feat_route_booking)))
    counts = None
    for name, df in frames.items():
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), "n")
        counts = one if counts is None else counts.unionByName(one)
    good = counts.agg(*[F.sum(F.when(F.col("part") == name, F.col("n"))).alias(name) for name in frames])
    good = good.selectExpr("*", "'job-1' as job_run_id", "'SUCCESS' as status", "1 as day")
    bad = good.selectExpr(
        "source_flight_rows", "0L as source_booking_rows", "0L as output_route_delay_rows",
        "0L as output_route_booking_rows", "'job-2' as job_run_id", "'FAILED' as status", "2 as day",
    )
    runs = good.unionByName(bad).selectExpr(
        "*",
        f"'{features.JOB_NAME}' as job_name",
        "make_timestamp(2026, 5, day, 0, 0, 0) as started_at",
        "make_timestamp(2026, 5, day, 0, 5, 0) as completed_at",
        "if(status = 'FAILED', 'no bookings file', null) as error_message",
    )
    return reports.rq_job_audit(runs)


register(
    "rq_top_delay_features",
    """select route, airline, flight_count, cancelled_count, round(avg_arr_delay_minutes,6) as avg_arr_delay_minutes, p95_arr_delay_minutes, carrier_delay_minutes,
 weather_delay_minutes, nas_delay_minutes, late_aircraft_delay_minutes from f_delay order by p95_arr_delay_minutes desc nulls last, route, airline limit 20""",
)(lambda t: reports.rq_top_delay_features(t.feat_route_delay))
register(
    "rq_top_booking_features",
    """select route, booking_event_count, confirmed_booking_events, cancelled_booking_events, distinct_customers, total_ticket_value,
 round(avg_ticket_price,6) as avg_ticket_price, web_booking_events, mobile_booking_events from f_booking order by total_ticket_value desc, route limit 20""",
)(lambda t: reports.rq_top_booking_features(t.feat_route_booking))
register("rq_quarantine_by_reason", "select source_name, reason, count(*) as record_count from quarantined group by 1,2")(
    lambda t: reports.rq_quarantine_by_reason(t.quarantine)
)

_PANEL_SQL = {
    "bi_total_revenue": "select sum(revenue)::double as sum__revenue from m_sales",
    "bi_total_bookings": "select sum(booking_count)::bigint as sum__booking_count from m_sales",
    "bi_avg_ticket": "select round(avg(average_ticket_value),6) as avg__average_ticket_value from m_sales",
    "bi_quarantined": "select count(*) as count from quarantined",
    "bi_top_routes": "select route, sum(revenue)::double as sum__revenue from m_route group by route order by sum(revenue) desc, route limit 10",
    "bi_booking_trend": """select booking_date::varchar as booking_date, booking_channel, sum(booking_count)::bigint as sum__booking_count,
 sum(confirmed_revenue)::double as sum__confirmed_revenue from m_trend group by m_trend.booking_date, booking_channel order by 1,2 limit 5000""",
    "bi_status_mix": "select booking_status, sum(booking_count)::bigint as sum__booking_count from m_status group by 1 order by 2 desc, 1 limit 20",
    "bi_delay_by_airline": """select airline, round(avg(avg_delay_minutes),6) as avg__avg_delay_minutes, round(avg(delayed_rate),6) as avg__delayed_rate
 from m_delay group by airline order by avg(avg_delay_minutes) desc, airline limit 15""",
    "bi_dq_by_rule": "select rule_name, severity, count(*) as count from dq_stored group by 1,2 order by 3 desc, 1, 2 limit 20",
    "bi_reconciliation": """select run_id, source_name, target_table, status, sum(source_file_rows)::bigint as sum__source_file_rows,
 sum(quarantined_rows)::bigint as sum__quarantined_rows, sum(expected_raw_rows)::bigint as sum__expected_raw_rows,
 sum(actual_raw_rows)::bigint as sum__actual_raw_rows, sum(difference)::bigint as sum__difference from recon group by 1,2,3,4 limit 1000""",
    "bi_quarantine_detail": """select '2026-05-01 00:00:00' as created_at, run_id, source_name, record_key, reason, file_path from quarantined
 order by quarantine_id limit 1000""",
}
for _name, _spec in reports.PANELS.items():
    register(_name, _PANEL_SQL[_name])(lambda t, spec=_spec: reports.bi_run_panel(t, spec))

_ORDER_METRICS = ", ".join(
    f"sum({c}){cast} as sum__{c}, round(avg({c}),6) as avg__{c}"
    for c, cast in (("o_orderkey", "::bigint"), ("o_custkey", "::bigint"))
)


@register(
    "bi_auto_metrics",
    f"""select count(*) as count, {_ORDER_METRICS}, round(sum(o_totalprice::decimal(18,2))::double,6) as sum__o_totalprice,
 round(avg(o_totalprice),6) as avg__o_totalprice from orders""",
)
def _(t: Tables):
    from pyspark.sql import functions as F

    orders = t.given("orders").withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))
    return reports.bi_auto_metrics(orders)


@register("bi_run_panel", "select booking_channel, sum(booking_count)::bigint as sum__booking_count, count(*) as count from m_trend group by 1")
def _(t: Tables):
    spec = reports.Panel("mart_booking_trend_daily", ("booking_channel",), ("sum__booking_count", "count"), limit=100)
    return reports.bi_run_panel(t, spec)
