"""Staging, dimensions, facts, intermediates, marts, features and assertions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import assertions, dedupe
from ..plans import features, marts, models, staging, upkeep
from ..session import work_folder
from ..sources.versions import Warehouse
from .fixtures import Tables
from .registry import register

# Staging -----------------------------------------------------------------------------------------

register(
    "stg_flights",
    """select flight_id, flight_date::varchar as flight_date, airline, null::varchar as tail_number, flight_number, origin_airport, destination_airport,
 route, null::int as crs_dep_time, null::int as dep_time, dep_delay_minutes, null::int as crs_arr_time, null::int as arr_time, arr_delay_minutes,
 cancelled::int as cancelled, null::varchar as cancellation_code, diverted::int as diverted, distance_miles, carrier_delay, weather_delay, nas_delay,
 security_delay, late_aircraft_delay from stg_f""",
)(lambda t: t.stg_flights.drop("loaded_at"))
register("stg_airports", "select * from stg_a")(lambda t: t.stg_airports.drop("loaded_at"))

_B = """booking_id, customer_id, flight_id, flight_date::varchar as flight_date, airline, origin_airport, destination_airport, route,
 booking_time::varchar as booking_time, booking_channel, customer_segment, ticket_price::double as ticket_price, currency, booking_status,
 payment_status, is_refunded, created_at::varchar as created_at, updated_at::varchar as updated_at"""
_P = """payment_id, booking_id, payment_time::varchar as payment_time, payment_method, payment_status, amount::double as amount, currency,
 refund_amount::double as refund_amount, created_at::varchar as created_at, updated_at::varchar as updated_at"""

register("stg_bookings", f"select {_B} from stg_b")(lambda t: t.stg_bookings.drop("loaded_at"))
register("stg_bookings_trim_first", f"select {_B} from stg_b_trim")(
    lambda t: staging.stg_bookings(t.raw_bookings, "trim_first").drop("loaded_at")
)
register("stg_payments", f"select {_P} from stg_p")(lambda t: t.stg_payments.drop("loaded_at"))
register("stg_payments_trim_first", f"select {_P} from stg_p_trim")(
    lambda t: staging.stg_payments(t.raw_payments, "trim_first").drop("loaded_at")
)

_LINE_ORDER = ["l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax"]


@register(
    "cdc_keep_latest",
    f"""select l_orderkey, l_linenumber, l_shipdate::varchar as l_shipdate, l_extendedprice, l_partkey from lineitem
qualify row_number() over (partition by l_orderkey, l_linenumber order by {', '.join(c + ' desc' for c in _LINE_ORDER)})=1""",
)
def _(t: Tables):
    latest = dedupe.keep_latest(t.given("lineitem"), ["l_orderkey", "l_linenumber"], _LINE_ORDER)
    return latest.select("l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice", "l_partkey")


# Dimensions, facts, intermediates -------------------------------------------------------------------

register("dim_airport", "select * from airport")(lambda t: t.dim_airport)
register("dim_airline", "select distinct airline, airline as airline_code from stg_f")(
    lambda t: models.dim_airline(t.stg_flights)
)
register(
    "dim_route",
    """select route, origin_airport, destination_airport, round(avg(distance_miles),6) as avg_distance_miles,
 count(*) as observed_flight_count from stg_f group by 1,2,3""",
)(lambda t: models.dim_route(t.stg_flights))
register(
    "dim_customer",
    """select customer_id, min(booking_time)::varchar as first_booking_time, max(booking_time)::varchar as latest_booking_time,
 count(*) as lifetime_booking_count, sum(case when booking_status='CONFIRMED' then ticket_price else 0 end)::double as lifetime_confirmed_revenue,
 max(customer_segment) as latest_customer_segment from stg_b group by 1""",
)(lambda t: models.dim_customer(t.stg_bookings))
register(
    "dim_date",
    """select d::varchar as date_day, year(d)::int as year, month(d)::int as month, day(d)::int as day, dayofweek(d)::int as day_of_week,
 quarter(d)::int as quarter from (select flight_date as d from stg_f union select flight_date from stg_b) z where d is not null""",
)(lambda t: models.dim_date(t.stg_flights, t.stg_bookings))
register(
    "fact_flight_status",
    """select flight_id, flight_date::varchar as flight_date, airline, origin_airport, destination_airport, route, distance_miles, dep_delay_minutes,
 arr_delay_minutes, delay_minutes, is_delayed, is_cancelled, is_diverted, null::varchar as cancellation_code, carrier_delay, weather_delay, nas_delay,
 security_delay, late_aircraft_delay from fact_f""",
)(lambda t: t.fact_flight_status)
register("fact_booking", f"select {_B} from fact_b")(lambda t: t.fact_booking)
register("fact_payment", f"select {_P} from fact_p")(lambda t: t.fact_payment)


def _earlier_fact(t: Tables):
    """The booking fact of an earlier run: other prices, some bookings under another id, some of these on dates that are gone."""
    agency, old = F.col("booking_channel") == "AGENCY", F.col("booking_channel").isin("AGENCY", "CALL_CENTER")
    return t.fact_booking.withColumns(
        {
            "flight_date": F.when(agency, F.date_sub("flight_date", 60)).otherwise(F.col("flight_date")),
            "booking_id": F.when(old, F.concat(F.lit("OLD-"), "booking_id")).otherwise(F.col("booking_id")),
            "ticket_price": (F.col("ticket_price") + 1).cast("decimal(18,2)"),
        }
    )


_OLD_B = _B.replace("booking_id,", "'OLD-'||booking_id as booking_id,", 1).replace("flight_date::varchar", "(flight_date-60)::varchar").replace("ticket_price::double", "(ticket_price+1)::double")


@register(
    "fact_booking_incremental",
    f"select {_B} from fact_b union all select {_OLD_B} from fact_b where booking_channel='AGENCY' and flight_date-60 not in (select flight_date from fact_b)",
)
def _(t: Tables):
    return models.fact_booking(t.stg_bookings, _earlier_fact(t))


_kept: dict[tuple[str, str], str] = {}


def _kept_up(t: Tables) -> Warehouse:
    """The booking tables after three runs: half of the originals, all rows again with later versions, and the same once more."""
    slot = (t.spark.sparkContext.applicationId, t.sf_dir)
    if slot in _kept:
        return Warehouse(t.spark, _kept[slot])
    house = Warehouse(t.spark, work_folder(t.spark, "upkeep"))
    runs = (("first", "dup = 0 and k % 2 = 0"), ("second", "true"), ("second", "true"), ("third", "true"))
    for label, rows in runs:
        upkeep.refresh_bookings(house, t.raw_bookings.where(rows), "60 days", label, buckets=8)
    _kept[slot] = house.root
    return house


register("fact_booking_upkeep", f"select {_B} from fact_b")(lambda t: _kept_up(t).read(upkeep.FACT))
register(
    "mart_sales_upkeep",
    """select flight_date::varchar as flight_date, airline, route, booking_count, revenue::double as revenue, round(average_ticket_value,6)::double as average_ticket_value,
 refund_amount::double as refund_amount, failed_payment_count from m_sales""",
)(lambda t: _kept_up(t).read(upkeep.SALES))
_DIM_CUSTOMER = """select customer_id, min(booking_time)::varchar as first_booking_time, max(booking_time)::varchar as latest_booking_time,
 count(*) as lifetime_booking_count, sum(case when booking_status='CONFIRMED' then ticket_price else 0 end)::double as lifetime_confirmed_revenue,
 max(customer_segment) as latest_customer_segment from stg_b group by 1"""
register("dim_customer_upkeep", _DIM_CUSTOMER)(lambda t: _kept_up(t).read(upkeep.CUSTOMERS))


register(
    "int_route_daily",
    """select flight_date::varchar as flight_date, route, origin_airport, destination_airport, flight_count, round(avg_delay_minutes,6) as avg_delay_minutes,
 delayed as delayed_flight_count, cancelled_count as cancelled_flight_count from route_day""",
)(lambda t: t.int_route_daily)
register(
    "int_flight_booking_bridge",
    """select flight_id, route, flight_date::varchar as flight_date, booking_count, confirmed_booking_count, confirmed_revenue::double as confirmed_revenue,
 refund_amount::double as refund_amount from bridge""",
)(lambda t: t.int_flight_booking_bridge)
register(
    "int_customer_booking",
    """select customer_id, booking_count, total_spend::double as total_spend, latest_booking_time::varchar as latest_booking_time,
 first_booking_time::varchar as first_booking_time, lifecycle_segment from cust""",
)(lambda t: t.int_customer_booking)

# Marts ---------------------------------------------------------------------------------------------

register(
    "mart_sales_performance",
    """select flight_date::varchar as flight_date, airline, route, booking_count, revenue::double as revenue,
 round(average_ticket_value,6) as average_ticket_value, refund_amount::double as refund_amount, failed_payment_count from m_sales""",
)(lambda t: t.mart_sales_performance)
register(
    "mart_booking_status_realtime",
    """select booking_status, payment_status, booking_count, latest_update_time::varchar as latest_update_time,
 gross_ticket_value::double as gross_ticket_value from m_status""",
)(lambda t: t.mart_booking_status_realtime)
register(
    "mart_booking_trend_daily",
    """select booking_date::varchar as booking_date, booking_hour, booking_channel, booking_count, confirmed_revenue::double as confirmed_revenue,
 cancelled_count from m_trend""",
)(lambda t: t.mart_booking_trend_daily)


@register(
    "mart_booking_trend_daily_incremental",
    """select booking_date::varchar as booking_date, booking_hour, booking_channel, booking_count, confirmed_revenue::double as confirmed_revenue,
 cancelled_count from m_trend
union all select (booking_date-90)::varchar, booking_hour, booking_channel, booking_count, confirmed_revenue::double, cancelled_count from m_trend
where booking_channel='WEB'""",
)
def _(t: Tables):
    now = t.mart_booking_trend_daily
    earlier = F.when(F.col("booking_channel") == "WEB", F.date_sub("booking_date", 90)).otherwise(F.col("booking_date"))
    existing = now.withColumn("booking_date", earlier)
    return marts.mart_booking_trend_daily(t.fact_booking, t.stg_bookings, existing)


_ROUTE = """route, origin_airport, destination_airport, booking_count, revenue::double as revenue, round(avg_delay_minutes,6) as avg_delay_minutes,
 round(delayed_rate,6) as delayed_rate, round(cancellation_rate,6) as cancellation_rate"""
register("mart_route_performance", f"select {_ROUTE} from m_route")(lambda t: t.mart_route_performance)
register(
    "mart_route_performance_grain_safe",
    f"""select {_ROUTE} from (select r.route, r.origin_airport, r.destination_airport, sum(coalesce(b.n,0))::bigint as booking_count,
 sum(coalesce(b.rev,0)) as revenue, avg(r.avg_delay_minutes) as avg_delay_minutes, sum(r.delayed)::double/sum(r.flight_count) as delayed_rate,
 sum(r.cancelled_count)::double/sum(r.flight_count) as cancellation_rate
from route_day r left join (select route, flight_date, sum(booking_count) as n, sum(confirmed_revenue) as rev from bridge group by 1,2) b
 on r.route=b.route and r.flight_date=b.flight_date group by 1,2,3) z""",
)(lambda t: marts.mart_route_performance_grain_safe(t.int_route_daily, t.int_flight_booking_bridge))
register("mart_airport_performance", "select * from m_airport")(lambda t: t.mart_airport_performance)
register(
    "mart_customer_segment",
    """select lifecycle_segment, customer_count, booking_count, total_spend::double as total_spend,
 round(avg_customer_spend,6) as avg_customer_spend from m_segment""",
)(lambda t: t.mart_customer_segment)
register(
    "mart_flight_delay_analysis",
    """select * replace (flight_date::varchar as flight_date, round(avg_delay_minutes,6) as avg_delay_minutes,
 round(delayed_rate,6) as delayed_rate) from m_delay""",
)(lambda t: t.mart_flight_delay_analysis)

# Features ------------------------------------------------------------------------------------------

register(
    "feat_route_delay",
    """select * replace (round(avg_dep_delay_minutes,6) as avg_dep_delay_minutes, round(avg_arr_delay_minutes,6) as avg_arr_delay_minutes,
 round(avg_distance_miles,6) as avg_distance_miles) from f_delay""",
)(lambda t: t.feat_route_delay)
register("feat_route_booking", "select * replace (round(avg_ticket_price,6) as avg_ticket_price) from f_booking")(
    lambda t: t.feat_route_booking
)


@register(
    "feat_job_audit",
    """select 'route_feature_job' as job_name, (select count(*) from flights) as source_flight_rows, (select count(*) from bookings) as source_booking_rows,
 (select count(*) from f_delay) as output_route_delay_rows, (select count(*) from f_booking) as output_route_booking_rows, 'SUCCESS' as status,
 null::varchar as error_message""",
)
def _(t: Tables):
    folder = work_folder(t.spark, "features")

    def write(df, name):
        df.write.mode("overwrite").parquet(f"{folder}/{name}")

    features.run_feature_job(t.spark, t.flights, t.bookings, "job-1", write)
    return t.spark.read.parquet(f"{folder}/spark_job_audit").drop("job_run_id", "started_at", "completed_at")


# Assertions ------------------------------------------------------------------------------------------
# Each count of the oracles is computed; sources and changed columns give checks that fail.

_BOOKED, _PAID = ["CONFIRMED", "CANCELLED", "PENDING"], ["PAID", "FAILED", "REFUNDED"]


def _models(t: Tables, names: set[str]) -> dict:
    """The models of these names; no other is built, because asking for a stored table writes it."""
    builders = {
        "stg_bookings": lambda: t.stg_bookings, "stg_payments": lambda: t.stg_payments, "dim_airport": lambda: t.dim_airport,
        "fact_booking": lambda: t.fact_booking, "fact_payment": lambda: t.fact_payment, "fact_flight_status": lambda: t.fact_flight_status,
        "raw_bts_flights": lambda: t.raw_flights, "bookings": lambda: t.bookings, "payments": lambda: t.payments,
        "checked_bookings": lambda: t.raw_bookings, "orders": lambda: t.given("orders"), "lineitem": lambda: t.given("lineitem"),
        "customer": lambda: t.given("customer").where("c_custkey % 10 <> 3"),
        "early_flights": lambda: t.fact_flight_status.selectExpr("flight_id", "delay_minutes - 30 as delay_minutes"),
    }
    return {name: build() for name, build in builders.items() if name in names}


#: The tables of the oracle under the names of the models.
_MODEL_SQL = {
    "stg_bookings": "stg_b", "stg_payments": "stg_p", "dim_airport": "airport", "fact_booking": "fact_b", "fact_payment": "fact_p",
    "fact_flight_status": "fact_f", "raw_bts_flights": "(select FlightDate as flight_date from flights)", "bookings": "bookings", "payments": "payments", "checked_bookings": "b_valid",
    "orders": "orders", "lineitem": "lineitem", "customer": "(select * from customer where c_custkey%10<>3)",
    "early_flights": "(select flight_id, delay_minutes-30 as delay_minutes from fact_f)",
}

_NOT_NULL = [
    assertions.not_null(m, c)
    for m, c in (
        ("stg_bookings", "booking_id"), ("stg_payments", "payment_id"), ("stg_payments", "booking_id"), ("dim_airport", "airport_code"),
        ("fact_booking", "booking_id"), ("fact_booking", "ticket_price"), ("fact_payment", "payment_id"), ("raw_bts_flights", "flight_date"),
    )
]
_UNIQUE = [
    assertions.unique(*c)
    for c in (
        ("stg_bookings", "booking_id"), ("stg_payments", "payment_id"), ("dim_airport", "airport_code"), ("fact_booking", "booking_id"),
        ("fact_payment", "payment_id"), ("lineitem", "l_orderkey", "l_linenumber"), ("bookings", "booking_id"), ("orders", "o_custkey"), ("lineitem", "l_partkey", "l_suppkey"),
    )
]
_ACCEPTED = [
    assertions.accepted("stg_bookings", "booking_status", _BOOKED), assertions.accepted("stg_bookings", "payment_status", _PAID),
    assertions.accepted("bookings", "booking_status", _BOOKED), assertions.accepted("orders", "o_orderpriority", ["1-URGENT", "2-HIGH"]),
]
_RELATED = [
    assertions.related("fact_payment", "booking_id", "fact_booking", "booking_id"), assertions.related("payments", "booking_id", "checked_bookings", "booking_id"),
    assertions.related("orders", "o_custkey", "customer", "c_custkey"),
]
_SIGNS = [
    assertions.non_negative("fact_flight_status", "delay_minutes"), assertions.non_negative("early_flights", "delay_minutes"), assertions.non_negative("fact_booking", "ticket_price"),
]


def _check_sql(c: assertions.Check) -> str:
    """One count by a subquery of its own."""
    table, cols = _MODEL_SQL[c.model], ", ".join(c.columns)
    whole = " and ".join(f"{x} is not null" for x in c.columns)
    count = {
        "not_null": f"(select count(*) from {table} z where {cols} is null)",
        "non_negative": f"(select count(*) from {table} z where {cols}<0)",
        "unique": f"(select count(*) from (select 1 from {table} z where {whole} group by {cols} having count(*)>1) y)",
        "accepted_values": f"(select count(distinct {cols}) from {table} z where {cols} not in ({', '.join(repr(v) for v in c.values)}))",
        "relationships": f"(select count(*) from {table} z where {cols} not in (select {c.parent[1]} from {_MODEL_SQL.get(c.parent[0])} y where {c.parent[1]} is not null))",
    }[c.test]
    return f"""select '{c.model}' as model, '{c.test}' as test, '{c.name().replace(' ', '')}' as "column", {count} as failures"""


def _suite(name: str, checks: list) -> None:
    @register(name, " union all ".join(_check_sql(c) for c in checks))
    def _(t: Tables):
        used = {c.model for c in checks} | {c.parent[0] for c in checks}
        return assertions.suite(_models(t, used), checks)


_suite("as_not_null", _NOT_NULL)
_suite("as_unique", _UNIQUE)
_suite("as_accepted_values", _ACCEPTED)
_suite("as_relationships", _RELATED)
_suite("as_suite", _NOT_NULL + _UNIQUE + _ACCEPTED + _RELATED + _SIGNS)

register("as_non_negative_delay", "select flight_id, delay_minutes-30 as delay_minutes from fact_f where delay_minutes<30")(
    lambda t: assertions.as_non_negative_delay(t.fact_flight_status.withColumn("delay_minutes", F.col("delay_minutes") - 30)).select("flight_id", "delay_minutes")
)
register(
    "as_non_negative_price",
    "select booking_id, (ticket_price-500)::double as ticket_price from fact_b where ticket_price<500",
)(lambda t: assertions.as_non_negative_price(t.fact_booking.withColumn("ticket_price", F.col("ticket_price") - 500)).select("booking_id", "ticket_price"))
