"""Filters, column functions and vocabularies, each projected over a source."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import functions as fn
from ..functions import vocab
from ..operators import filters
from .fixtures import Tables
from .oracle import BSTATUS, CHANNEL, METHOD, PSTATUS, SEGMENT, bare_token, dirty, raw_token, words
from .registry import register


def _on_bookings(name: str, columns: Callable[[], dict[str, Column]], sql: str) -> None:
    register(name, f"select k, dup, {sql} from bookings")(
        lambda t: t.bookings.select("k", "dup", *[c.alias(n) for n, c in columns().items()])
    )


def _on_payments(name: str, columns: Callable[[], dict[str, Column]], sql: str) -> None:
    register(name, f"select k, dup, {sql} from payments")(
        lambda t: t.payments.select("k", "dup", *[c.alias(n) for n, c in columns().items()])
    )


# Filters ---------------------------------------------------------------------------------------


@register("flt_required_key", "select k, dup, booking_id from bookings where trim(booking_id)<>''")
def _(t: Tables):
    return filters.drop_blank_key(t.bookings, "booking_id").select("k", "dup", "booking_id")


@register(
    "flt_not_null_all",
    "select flight_key, FlightDate as flight_date, Origin as origin, Dest as dest from flights where FlightDate is not null",
)
def _(t: Tables):
    rows = t.flights.select(
        "flight_key", F.col("FlightDate").alias("flight_date"), F.col("Origin").alias("origin"), F.col("Dest").alias("dest")
    )
    return filters.not_null_all(rows, "flight_date", "origin", "dest")


@register(
    "flt_flown_flights",
    """select flight_key, FlightDate as flight_date, Reporting_Airline as airline from flights
where FlightDate is not null and Cancelled=0 and Diverted=0""",
)
def _(t: Tables):
    return filters.flown_flights(t.flights).select(
        "flight_key", F.col("FlightDate").alias("flight_date"), F.col("Reporting_Airline").alias("airline")
    )


@register(
    "flt_equals_subquery",
    """select run_id, source_name, actual_raw_rows from recon where run_id=(select run_id from recon order by created_at desc limit 1)""",
)
def _(t: Tables):
    return filters.latest_run(t.reconciliation, "run_id", "created_at").select(
        "run_id", "source_name", "actual_raw_rows"
    )


_REPLAYED = """select k, dup, flight_date from bookings where flight_date {} (select flight_date from bookings where dup=1)"""


@register("flt_in_subquery", _REPLAYED.format("in"))
def _(t: Tables):
    rows = t.bookings.select("k", "dup", "flight_date")
    return filters.rows_in(rows, rows.where("dup = 1"), "flight_date").select("k", "dup", "flight_date")


@register("flt_in_subquery_anti", _REPLAYED.format("not in"))
def _(t: Tables):
    rows = t.bookings.select("k", "dup", "flight_date")
    return filters.rows_in(rows, rows.where("dup = 1"), "flight_date", anti=True).select("k", "dup", "flight_date")


@register(
    "flt_like_any",
    """select k, dup, flight_id from bookings where regexp_matches(flight_id,'^AA-') or regexp_matches(flight_id,'-A0[03]-A07$')""",
)
def _(t: Tables):
    patterns = ["AA-%", "%-A00-A07", "%-A03-A07"]
    return filters.where_like_any(t.bookings, "flight_id", patterns).select("k", "dup", "flight_id")


# Text ------------------------------------------------------------------------------------------

_on_bookings(
    "fn_trim_upper",
    lambda: {"id": fn.trim_upper("booking_id"), "airline_code": fn.trim_upper("airline"), "money": fn.trim_upper("currency")},
    "upper(trim(booking_id)) as id, upper(trim(airline)) as airline_code, upper(trim(currency)) as money",
)


@register("fn_trim_lower", "select id, lower(trim(type)) as kind, lower(trim(scheduled_service)) as scheduled from airports")
def _(t: Tables):
    return t.airports.select(
        "id", fn.trim_lower("type").alias("kind"), fn.trim_lower("scheduled_service").alias("scheduled")
    )


_on_bookings(
    "fn_blank_to_null",
    lambda: {"customer": fn.blank_to_null("customer_id")},
    "case when trim(customer_id)<>'' then trim(customer_id) end as customer",
)


@register(
    "fn_coalesce_default",
    """select flight_key, case when DepDelayMinutes is null then 0.0 else DepDelayMinutes::double end as delay,
 ifnull(SecurityDelay,0)::double as security from flights""",
)
def _(t: Tables):
    return t.flights.select(
        "flight_key",
        fn.default(fn.try_number("DepDelayMinutes"), 0.0).alias("delay"),
        fn.default(fn.try_number("SecurityDelay"), 0.0).alias("security"),
    )


@register(
    "fn_coalesce_chain",
    "select id, case when iata_code<>'' then iata_code when gps_code is not null then gps_code else ident end as code from airports",
)
def _(t: Tables):
    return t.airports.select("id", fn.first_present("iata_code", "gps_code", "ident").alias("code"))


_on_bookings(
    "fn_token_replace_first",
    lambda: {"channel": fn.token_replace_first("booking_channel"), "status": fn.token_replace_first("booking_status")},
    f"{raw_token('booking_channel')} as channel, {raw_token('booking_status')} as status",
)
_on_bookings(
    "fn_token_trim_first",
    lambda: {"channel": fn.token_trim_first("booking_channel"), "status": fn.token_trim_first("booking_status")},
    f"{bare_token('booking_channel')} as channel, {bare_token('booking_status')} as status",
)
_on_bookings(
    "fn_strip_terminal",
    lambda: {"origin": fn.strip_terminal("origin_airport"), "destination": fn.strip_terminal("destination_airport")},
    """regexp_extract(upper(trim(origin_airport)),'^(.*?)(-T[0-9]+)?$',1) as origin,
 regexp_extract(upper(trim(destination_airport)),'^(.*?)(-T[0-9]+)?$',1) as destination""",
)
_on_bookings(
    "fn_strip_terminal_feature",
    lambda: {"origin": fn.strip_terminal_feature("origin_airport"), "status": fn.strip_terminal_feature(F.concat(F.lit(" x-T1"), "airline"))},
    """upper(trim(regexp_replace(origin_airport,'-T[0-9]+$',''))) as origin, upper('x-T1'||trim(airline)) as status""",
)
_on_bookings(
    "fn_route_concat",
    lambda: {
        "route_name": fn.route("origin_airport", "destination_airport"),
        "open_route": fn.route(fn.blank_to_null("customer_id"), "airline"),
    },
    "origin_airport||'-'||destination_airport as route_name, ifnull(nullif(trim(customer_id),''),'')||'-'||airline as open_route",
)
_on_bookings(
    "fn_route_concat_ws",
    lambda: {
        "route_name": fn.route_ws("origin_airport", "destination_airport"),
        "open_route": fn.route_ws(fn.blank_to_null("customer_id"), "airline"),
    },
    """origin_airport||'-'||destination_airport as route_name,
 case when trim(customer_id)='' then airline else trim(customer_id)||'-'||airline end as open_route""",
)
_on_bookings(
    "fn_dirty_token",
    lambda: {"status_dirty": fn.dirty_token("booking_status"), "channel_dirty": fn.dirty_token("booking_channel")},
    f"{dirty('booking_status')} as status_dirty, {dirty('booking_channel')} as channel_dirty",
)


@register("fn_truncate_error", "select doc_id, left(text,2000) as message from documents")
def _(t: Tables):
    return t.given("documents").select("doc_id", fn.clip("text", 2000).alias("message"))


# Numbers, booleans, keys -------------------------------------------------------------------------

_on_bookings(
    "fn_abs",
    lambda: {"price": fn.abs_value(fn.try_number("ticket_price"))},
    "abs(try_cast(ticket_price as double)) as price",
)
_on_payments(
    "fn_greatest",
    lambda: {
        "floored": fn.floor_at(fn.try_number("amount"), 0.0),
        "changed": fn.floor_at(F.col("updated_at").try_cast("timestamp_ntz"), F.col("created_at").try_cast("timestamp_ntz")),
    },
    """case when try_cast(amount as double)>0 then try_cast(amount as double) else 0.0 end::double as floored,
 case when updated_at>created_at then updated_at else created_at end as changed""",
)
_on_bookings(
    "fn_bool_words",
    lambda: {"refunded": fn.bool_words("is_refunded"), "missing": fn.bool_words(fn.blank_to_null("customer_id"))},
    "lower(trim(is_refunded)) in ('true','t','1','yes','y') as refunded, false as missing",
)


@register(
    "fn_compare_to_bool",
    "select flight_key, Cancelled=1 as is_cancelled, DepDelayMinutes>=15 as is_late from flights",
)
def _(t: Tables):
    return t.flights.select(
        "flight_key",
        fn.flag(fn.try_number("Cancelled"), "=", 1).alias("is_cancelled"),
        fn.flag(fn.try_number("DepDelayMinutes"), ">=", 15).alias("is_late"),
    )


@register(
    "fn_md5_key",
    """select flight_key, md5(concat_ws('|',Reporting_Airline,Flight_Number_Reporting_Airline,FlightDate,Origin,Dest)) as flight_id from flights""",
)
def _(t: Tables):
    key = fn.md5_key("Reporting_Airline", "Flight_Number_Reporting_Airline", "FlightDate", "Origin", "Dest")
    return t.flights.select("flight_key", key.alias("flight_id"))


_on_bookings(
    "fn_md5_ids",
    lambda: {"id": fn.md5_id(F.lit("bookings"), "row_number", fn.blank_to_null("customer_id"))},
    "md5('bookings|'||row_number||'|'||ifnull(nullif(trim(customer_id),''),'')) as id",
)

_UUID = """(select k, dup, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8')||encode(booking_id||'|'||updated_at)) as h from bookings)"""


@register(
    "fn_uuid5",
    f"""select k, dup, substr(h,1,8)||'-'||substr(h,9,4)||'-5'||substr(h,14,3)||'-'||
 case when substr(h,17,1) in ('0','4','8','c') then '8' when substr(h,17,1) in ('1','5','9','d') then '9'
  when substr(h,17,1) in ('2','6','a','e') then 'a' else 'b' end||substr(h,18,3)||'-'||substr(h,21,12) as id from {_UUID} z""",

)
def _(t: Tables):
    return t.bookings.select("k", "dup", fn.uuid5(F.concat_ws("|", "booking_id", "updated_at")).alias("id"))


_on_bookings(
    "fn_try_number",
    lambda: {"price": fn.try_number("ticket_price"), "is_number": fn.is_number("ticket_price")},
    "try_cast(ticket_price as double) as price, try_cast(ticket_price as double) is not null as is_number",
)
_on_bookings(
    "fn_try_date",
    lambda: {"day": fn.try_date("flight_date"), "is_date": fn.is_date("flight_date")},
    "try_cast(flight_date as date)::varchar as day, try_cast(flight_date as date) is not null as is_date",
)
_on_bookings(
    "fn_date_trunc_cast",
    lambda: {"day": fn.date_trunc_cast(F.col("booking_time").cast("timestamp_ntz"))},
    "substr(booking_time,1,10) as day",
)
_on_bookings(
    "fn_extract_hour",
    lambda: {"hour": fn.extract_hour(F.col("booking_time").cast("timestamp_ntz"))},
    "substr(booking_time,12,2)::int as hour",
)


@register(
    "fn_extract_calendar",
    """select o_orderkey, extract(year from o_orderdate)::int as year, extract(month from o_orderdate)::int as month,
 extract(day from o_orderdate)::int as day, extract(dow from o_orderdate)::int as day_of_week, extract(quarter from o_orderdate)::int as quarter
from orders""",
)
def _(t: Tables):
    return t.given("orders").select("o_orderkey", *fn.calendar("o_orderdate"))


_MESSAGE_ID = "topic, kafka_offset"


@register(
    "fn_iso_z",
    f"""select {_MESSAGE_ID}, try_cast(replace(replace(json_extract_string(j,'$.event_time'),'T',' '),'Z','') as timestamp)::varchar as at from env_parsed""",
)
def _(t: Tables):
    return t.messages.select(
        "topic", "kafka_offset", fn.iso_z(F.get_json_object("value", "$.event_time")).alias("at")
    )


@register("fn_json_text", "select event_id, json_extract_string(props,'$.k') as k_text from events")
def _(t: Tables):
    return t.given("events").select("event_id", fn.json_text("props", "$.k").alias("k_text"))


@register(
    "fn_json_object_build",
    """select event_id, '{"event_id":'||event_id||',"event_type":"'||event_type||'","nothing":null}' as body from events""",
)
def _(t: Tables):
    body = fn.row_json("event_id", "event_type", F.lit(None).cast("string").alias("nothing"))
    return t.given("events").select("event_id", body.alias("body"))


@register("fn_json_is_object", f"select {_MESSAGE_ID}, ok as is_object from env_parsed")
def _(t: Tables):
    return t.messages.select("topic", "kafka_offset", fn.json_is_object("value").alias("is_object"))


@register(
    "fn_ratio_nullif",
    """select Origin as origin, sum(Cancelled)::double/nullif(sum(Diverted),0) as cancelled_per_diverted,
 null::double as per_nothing from flights group by Origin""",
)
def _(t: Tables):
    cancelled, diverted = F.sum(fn.try_number("Cancelled")), F.sum(fn.try_number("Diverted"))
    return t.flights.groupBy(F.col("Origin").alias("origin")).agg(
        fn.ratio(cancelled, diverted).alias("cancelled_per_diverted"),
        fn.ratio(cancelled, F.lit(0.0)).alias("per_nothing"),
    )


_on_bookings("fn_now", lambda: {"is_set": fn.now().cast("timestamp_ntz") > F.col("booking_time").cast("timestamp_ntz")}, "true as is_set")

# Vocabularies ------------------------------------------------------------------------------------

_on_bookings(
    "voc_booking_channel",
    lambda: {"term": fn.map_vocab(fn.token_replace_first("booking_channel"), vocab.BOOKING_CHANNEL)},
    f"{words(raw_token('booking_channel'), CHANNEL, chr(39) + 'WEB' + chr(39))} as term",
)
_on_bookings(
    "voc_customer_segment",
    lambda: {"term": fn.map_vocab(fn.token_replace_first("customer_segment"), vocab.CUSTOMER_SEGMENT)},
    f"{words(raw_token('customer_segment'), SEGMENT, chr(39) + 'NEW' + chr(39))} as term",
)
_on_bookings(
    "voc_booking_status",
    lambda: {"term": fn.map_vocab(fn.token_replace_first("booking_status"), vocab.BOOKING_STATUS)},
    f"{words(raw_token('booking_status'), BSTATUS, chr(39) + 'PENDING' + chr(39))} as term",
)
_on_bookings(
    "voc_booking_status_feature",
    lambda: {"term": fn.map_vocab(fn.trim_upper("booking_status"), vocab.BOOKING_STATUS_FEATURE)},
    f"{words('upper(trim(booking_status))', BSTATUS, 'upper(trim(booking_status))')} as term",
)
_on_bookings(
    "voc_payment_status",
    lambda: {"term": fn.map_vocab(fn.token_replace_first("payment_status"), vocab.PAYMENT_STATUS)},
    f"{words(raw_token('payment_status'), PSTATUS, chr(39) + 'FAILED' + chr(39))} as term",
)
_on_payments(
    "voc_payment_method",
    lambda: {"term": fn.map_vocab(fn.token_replace_first("payment_method"), vocab.PAYMENT_METHOD)},
    f"{words(raw_token('payment_method'), METHOD, chr(39) + 'UNKNOWN' + chr(39))} as term",
)
_on_bookings(
    "voc_booking_event_type",
    lambda: {"term": fn.map_vocab(F.upper(fn.strip("booking_status")), vocab.BOOKING_EVENT_TYPE)},
    """case upper(trim(booking_status)) when 'CONFIRMED' then 'BOOKING_CREATED' when 'CANCELLED' then 'BOOKING_CANCELLED'
 else 'BOOKING_UPDATED' end as term""",
)
_on_bookings(
    "voc_payment_event_type",
    lambda: {"term": fn.map_vocab(F.upper(fn.strip("payment_status")), vocab.PAYMENT_EVENT_TYPE)},
    """case upper(trim(payment_status)) when 'PAID' then 'PAYMENT_CAPTURED' when 'FAILED' then 'PAYMENT_FAILED'
 when 'REFUNDED' then 'PAYMENT_REFUNDED' else 'PAYMENT_UPDATED' end as term""",
)
