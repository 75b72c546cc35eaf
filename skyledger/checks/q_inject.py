"""Dirty-data injection."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import inject
from .fixtures import Tables
from .registry import register

SEED = 42
_SPAN = 1 << 28


def _draw(key: str, name: str) -> str:
    return f"('0x'||substr(md5('{SEED}|'||{key}||'|{name}'),1,7))::bigint"


def _hit(key: str, rate: float, name: str) -> str:
    return f"{_draw(key, name)}<{int(rate * _SPAN)}"


def _orders(t: Tables):
    return t.given("orders").select("o_orderkey", "o_orderpriority")


@register(
    "inj_text",
    f"""select o_orderkey, case when {_hit('o_orderkey', 0.4, 'text?')} then case {_draw('o_orderkey', 'text=')}%4 when 0 then lower(v) when 1 then
 case v when 'MOBILE_APP' then 'Mobile_App' when 'CALL_CENTER' then 'Call_Center' else 'Web' end
 when 2 then ' '||v||' ' else replace(v,'_',' ') end else v end as v
from (select o_orderkey, case o_orderstatus when 'O' then 'MOBILE_APP' when 'F' then 'CALL_CENTER' else 'WEB' end as v from orders) z""",
)
def _(t: Tables):
    status = F.col("o_orderstatus")
    value = F.when(status == "O", "MOBILE_APP").when(status == "F", "CALL_CENTER").otherwise("WEB")
    return t.given("orders").select("o_orderkey", inject.inj_text(value, "o_orderkey", 0.4, SEED).alias("v"))


@register(
    "inj_airport",
    f"""select flight_key, case when {_hit('flight_key', 0.3, 'airport?')} then case {_draw('flight_key', 'airport=')}%3 when 0 then lower(Origin)
 when 1 then ' '||Origin||' ' else Origin||'-T1' end else Origin end as origin from flights""",
)
def _(t: Tables):
    return t.flights.select("flight_key", inject.inj_airport("Origin", "flight_key", 0.3, SEED).alias("origin"))


def _variant(status: str, spellings: list[str], key: str) -> str:
    words = "[" + ",".join(f"'{w}'" for w in spellings) + "]"
    return f"when '{status}' then ({words})[1+{_draw(key, 'status=')}%{len(spellings)}]"


@register(
    "inj_status",
    f"""select o_orderkey, case when {_hit('o_orderkey', 0.5, 'status?')} then case v
 {_variant('CONFIRMED', ['confirmed', 'CONF', 'Booked', ' complete '], 'o_orderkey')} {_variant('CANCELLED', ['cancelled', 'CANCELED', 'VOID', ' cncl '], 'o_orderkey')}
 {_variant('PENDING', ['pending', 'PEND', 'IN_PROGRESS', ' awaiting_payment '], 'o_orderkey')} end else v end as v
from (select o_orderkey, case o_orderstatus when 'O' then 'CONFIRMED' when 'F' then 'CANCELLED' else 'PENDING' end as v from orders) z""",
)
def _(t: Tables):
    status = F.col("o_orderstatus")
    value = F.when(status == "O", "CONFIRMED").when(status == "F", "CANCELLED").otherwise("PENDING")
    dirty = inject.inj_status(value, "o_orderkey", 0.5, SEED, inject.BOOKING_VARIANTS)
    return t.given("orders").select("o_orderkey", dirty.alias("v"))


_PLAIN = """select o_orderkey as id, case o_orderstatus when 'O' then 'CONFIRMED' when 'F' then 'CANCELLED' else 'PENDING' end as status,
 cast(o_orderkey%900+50 as string)||'.50' as price, '2026-03-01 10:00:00' as updated_at from orders"""


def _plain(t: Tables):
    return t.sql(_PLAIN, "orders")


@register(
    "inj_duplicate",
    f"""select id, 0 as replay, status, price, updated_at from plain
union all select id, 1, case {_draw('id', 'replay status=')}%4 when 0 then lower(status) when 1 then upper(substr(status,1,1))||lower(substr(status,2))
 when 2 then ' '||status||' ' else status end,
 (price::decimal(18,2)+([-1.00,1.00,2.50]::decimal(18,2)[])[1+{_draw('id', 'replay amount')}%3])::decimal(18,2)::varchar,
 (updated_at::timestamp+to_hours((1+{_draw('id', 'replay hours')}%48)::int))::varchar from plain where {_hit('id', 0.2, 'replay?')}""",
    plain=_PLAIN,
)
def _(t: Tables):
    both = inject.inj_duplicate(_plain(t), "id", 0.2, SEED, "status", "price")
    return both.select("id", "replay", "status", "price", "updated_at")


@register(
    "inj_critical",
    f"""select id, case when hit and w=0 then '' else booking_id end as booking_id, case when hit and w=1 then 'not-a-date' else flight_date end as flight_date,
 case when hit and w=2 then 'not-a-number' else ticket_price end as ticket_price
from (select row_number as id, booking_id, flight_date, ticket_price, {_hit('row_number', 0.1, 'critical?')} as hit, {_draw('row_number', 'critical=')}%3 as w from bookings) z""",
)
def _(t: Tables):
    rows = t.bookings.select(F.col("row_number").alias("id"), "booking_id", "flight_date", "ticket_price")
    return inject.inj_critical(rows, "id", 0.1, SEED, inject.BOOKING_ISSUES)


@register(
    "inj_numeric_time",
    f"""select id, case when {_hit('id', 0.1, 'negative?')} then -ticket_price else ticket_price end::double as ticket_price,
 case when {_hit('id', 0.1, 'out of order?')} then created_at-interval 1 hour else updated_at end::varchar as updated_at,
 case when {_hit('id', 0.1, 'missing customer?')} then '' else customer_id end as customer_id,
 case when {_hit('id', 0.1, 'mismatch?')} and amount<>0 then amount+([-5.00,-2.50,3.00,7.50]::decimal(18,2)[])[1+{_draw('id', 'mismatch=')}%4] else amount end::double as amount
from typed_orders""",
    typed_orders="""select o_orderkey as id, (o_orderkey%900+50)::decimal(18,2) as ticket_price, timestamp '2026-03-01 10:00:00' as created_at,
 timestamp '2026-03-01 12:00:00' as updated_at, 'CUST-'||o_custkey as customer_id, (o_orderkey%7)::decimal(18,2) as amount from orders""",
)
def _(t: Tables):
    rows = t.given("orders").selectExpr(
        "o_orderkey as id",
        "cast(o_orderkey % 900 + 50 as decimal(18,2)) as ticket_price",
        "timestamp_ntz'2026-03-01 10:00:00' as created_at",
        "timestamp_ntz'2026-03-01 12:00:00' as updated_at",
        "concat('CUST-', o_custkey) as customer_id",
        "cast(o_orderkey % 7 as decimal(18,2)) as amount",
    )
    rates = {"negative": 0.1, "out_of_order": 0.1, "missing_customer": 0.1, "mismatch": 0.1}
    return inject.inj_numeric_time(rows, "id", rates, SEED).drop("created_at")
