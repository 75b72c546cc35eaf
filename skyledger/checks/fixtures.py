"""Source tables derived from the given ones, and every warehouse table on top of them.

The SQL text below runs unchanged in Spark and DuckDB. It uses integer arithmetic only, so both
produce identical text. Every row of the given tables is used.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..operators import audit, quality
from ..plans import features, marts, models, staging
from ..session import work_folder
from ..sources import files, tables
from ..streaming import landing
from ..streaming.envelope import STREAM_TABLES, st_validate_envelope

BOOKINGS_SQL = """
select k, dup, 
 case when k%307=5 then '' when k%37=1 then ' bkg-'||cast(k as string)||' ' else 'BKG-'||cast(k as string) end as booking_id,
 case when k%50=0 then '' when k%7=0 then 'CUST-X'||cast(k as string) else 'CUST-'||cast(ck as string) end as customer_id,
 al||'-'||cast(k%1000 as string)||'-202604'||dd||'-'||o||'-'||d as flight_id,
 case when k%313=7 then 'not-a-date' else '2026-04-'||dd end as flight_date,
 case when k%41=2 then lower(al) else al end as airline,
 case when k%43=3 then o||'-T1' when k%47=4 then ' '||lower(o)||' ' else o end as origin_airport,
 case when k%53=6 then d||'-T2' else d end as destination_airport,
 '2026-03-'||lpad(cast(1+k%25 as string),2,'0')||' '||lpad(cast(k%24 as string),2,'0')||':15:00' as booking_time,
 case k%10 when 0 then 'WEB' when 1 then 'WEB' when 2 then 'web' when 3 then ' WEB ' when 4 then 'MOBILE_APP' when 5 then 'mobile app' when 6 then ' MOBILE_APP ' when 7 then 'AGENCY' when 8 then 'CALL CENTER' else 'Phone' end as booking_channel,
 case k%6 when 0 then 'NEW' when 1 then 'Returning' when 2 then 'REPEAT' when 3 then 'BUSINESS' when 4 then 'loyal' else ' LOYALTY ' end as customer_segment,
 case when k%311=9 then 'not-a-number' when k%101=0 then '-'||pr else pr end as ticket_price,
 case when k%61=0 then ' usd ' else 'USD' end as currency,
 case when k%401=11 then 'ON_HOLD' when st='P' and k%2=0 then (case k%3 when 0 then 'CANCELLED' when 1 then 'VOID' else ' cncl ' end) when st='P' then (case k%3 when 0 then 'PENDING' when 1 then 'pend' else ' awaiting_payment ' end) else (case k%5 when 0 then 'CONF' when 1 then 'Booked' when 2 then ' complete ' else 'CONFIRMED' end) end as booking_status,
 ps as payment_status,
 case when ps in ('REFUNDED','CHARGEBACK') then (case k%4 when 0 then 'true' when 1 then 'TRUE' when 2 then '1' else 'yes' end) else 'false' end as is_refunded,
 case when dup=1 then '2026-04-02 12:00:00' when k%59=0 then '2026-02-27 00:00:00' else '2026-03-'||lpad(cast(2+k%25 as string),2,'0')||' '||lpad(cast(k%24 as string),2,'0')||':45:00' end as updated_at,
 pr
from (select *, case k%5 when 0 then 'AA' when 1 then 'DL' when 2 then 'UA' when 3 then 'WN' else 'B6' end as al,
  lpad(cast(1+k%30 as string),2,'0') as dd, 'A'||lpad(cast(ck%10 as string),2,'0') as o, 'A'||lpad(cast((ck%10+1+k%9)%10 as string),2,'0') as d,
  cast(30+(k*37)%970+dup as string)||'.50' as pr,
  case pri when '1-URGENT' then 'PAID' when '2-HIGH' then ' paid ' when '3-MEDIUM' then 'SUCCESS' when '4-NOT SPECIFIED' then (case when k%2=0 then 'DECLINED' else 'FAILED' end) else (case when k%2=0 then 'REFUNDED' else 'CHARGEBACK' end) end as ps
 from (select o_orderkey k,o_custkey ck,o_orderstatus st,o_orderpriority pri,0 dup from orders union all select o_orderkey,o_custkey,o_orderstatus,o_orderpriority,1 from orders where o_orderkey%33=8) z) y
"""

PAYMENTS_SQL = """
select k, dup, case when k%331=4 then '' when k%29=1 then ' pay-'||cast(k as string)||' ' else 'PAY-'||cast(k as string) end as payment_id,
 case when k%337=8 then '' when k%347=6 then 'BKG-MISSING' else booking_id end as booking_id, substr(booking_time,1,13)||':20:00' as payment_time,
 case k%8 when 0 then 'CREDIT_CARD' when 1 then 'credit card' when 2 then 'VISA' when 3 then 'DEBIT_CARD' when 4 then 'DC' when 5 then 'PayPal' when 6 then ' BANK_TRANSFER ' else 'CRYPTO' end as payment_method,
 payment_status, case when k%317=2 then 'not-a-number' when k%71=0 then '-'||pr when payment_status in ('FAILED','DECLINED') then '0' else pr end as amount, currency,
 case when payment_status in ('REFUNDED','CHARGEBACK') then pr else '0' end as refund_amount, booking_time as created_at, updated_at
from bk
"""

FLIGHTS_SQL = """
select cast(l_orderkey as string)||'-'||cast(l_linenumber as string)||'-'||cast(l_partkey as string)||'-'||cast(l_suppkey as string) as flight_key,
 case when l_partkey%211=0 then null else '2026-04-'||lpad(cast(1+l_orderkey%30 as string),2,'0') end as FlightDate,
 case l_suppkey%5 when 0 then 'AA' when 1 then 'DL' when 2 then 'UA' when 3 then 'WN' else 'B6' end as Reporting_Airline,
 cast(l_partkey%1000 as string) as Flight_Number_Reporting_Airline,
 'A'||lpad(cast(l_suppkey%10 as string),2,'0') as Origin, 'A'||lpad(cast((l_suppkey%10+1+l_partkey%9)%10 as string),2,'0') as Dest,
 case when l_returnflag='R' then cast(l_quantity as int) when l_returnflag='A' then 0 end as DepDelayMinutes,
 case when l_returnflag='R' then greatest(cast(l_quantity as int)-10,0) when l_returnflag='A' then 0 end as ArrDelayMinutes,
 case when l_linestatus='F' and l_partkey%20=0 then 1 else 0 end as Cancelled, case when l_partkey%97=0 then 1 else 0 end as Diverted,
 200+l_partkey%2000 as Distance,
 case when l_returnflag='R' then cast(round(l_discount*100) as int) end as CarrierDelay, case when l_returnflag='R' then cast(round(l_tax*100) as int) end as WeatherDelay,
 case when l_returnflag='R' then cast(l_quantity as int)%7 end as NASDelay, case when l_returnflag='R' and l_linenumber=1 then 2 end as SecurityDelay, case when l_returnflag='R' then cast(l_quantity as int)%5 end as LateAircraftDelay
from lineitem
"""

AIRPORTS_SQL = """
select n_nationkey*2+v as id, case v when 0 then 'K' else 'X' end||code as ident, case v when 0 then ' Large_Airport ' else 'heliport' end as type, ' '||n_name||' ' as name,
 cast(n_nationkey*3-36 as string)||'.25' as latitude_deg, cast(n_nationkey*7-84 as string)||'.5' as longitude_deg, cast(n_nationkey*100 as string) as elevation_ft, 'R'||cast(n_regionkey as string) as continent,
 'c'||cast(n_regionkey as string) as iso_country, 'c'||cast(n_regionkey as string)||'-'||cast(n_nationkey as string) as iso_region, case when n_nationkey%4=0 then '  ' else 'City '||cast(n_nationkey as string) end as municipality,
 case v when 0 then 'yes' else 'no' end as scheduled_service, case when n_nationkey%9=8 then null else lower(code) end as gps_code, case when v=0 and n_nationkey%9<>8 then code else '' end as iata_code
from (select n.*, 'A'||lpad(cast(n_nationkey as string),2,'0') as code, 0 as v from nation n union all select n.*, 'A'||lpad(cast(n_nationkey as string),2,'0'), 1 from nation n) y
"""

MESSAGES_SQL = """
select case when event_type in ('purchase','signup') then 'payment_events' else 'booking_events' end as topic, cast(user_id%3 as int) as partition, event_id*2+r as kafka_offset,
 case when event_id%503=7 then '{not json' else '{"event_id":"'||case when event_id%401=3 then '' else 'e'||cast(event_id as string) end||'","event_type":"'||upper(event_type)||'","event_time":"'||case when event_id%409=5 then 'yesterday' else '2026-04-'||lpad(cast(1+event_id%30 as string),2,'0')||'T'||lpad(cast(event_id%24 as string),2,'0')||':00:00Z' end||'","source_system":"fixture","schema_version":'||case when event_id%419=9 then '"x"' else '1' end||',"entity_key":"u'||cast(user_id as string)||'","payload":'||case when event_id%421=11 then '"text"' else props end||'}' end as value
from (select e.*, 0 as r from events e union all select e.*, 1 from events e where event_id%25=0) y
"""

# One delivered file per month of orders, with the earlier loads of the same slices: months 0 mod 3 hold
# the same content, months 1 mod 3 held it once and were then replaced, months 2 mod 3 are new.
FILES_SQL = """
select 'bookings' as source_name, 'raw.raw_bookings' as target_table,
 'landing/bookings/dt='||mon||'/bookings.csv' as file_path, cast(substr(mon,6,2) as int) as m,
 md5(cast(row_count as string)||'-'||cast(total as string)) as checksum_md5, row_count*100 as file_size_bytes,
 row_count, row_count as source_rows, valid_rows, row_count-valid_rows as quarantined_rows
from (select substr(cast(o_orderdate as string),1,7) as mon, count(*) as row_count, cast(sum(o_custkey) as bigint) as total,
  cast(sum(case when o_orderkey%313=7 then 0 else 1 end) as bigint) as valid_rows
 from orders group by substr(cast(o_orderdate as string),1,7)) z
"""

LOAD_HISTORY_SQL = """
select md5(run_id||'|'||source_name||'|'||target_table||'|'||checksum_md5) as load_audit_id, *
from (
 select case when m%4=0 then 'run-2' else 'run-1' end as run_id, source_name, target_table, file_path, checksum_md5,
  source_rows, valid_rows, quarantined_rows, valid_rows as inserted_rows, 0 as skipped_rows, 'LOADED' as load_status,
  '2026-05-01 01:00:00' as completed_at from files where m%3 in (0,1)
 union all
 select 'run-1b', source_name, target_table, file_path, md5(checksum_md5), source_rows, valid_rows, quarantined_rows,
  valid_rows, 0, 'LOADED', '2026-05-02 01:00:00' from files where m%3=1
 union all
 select 'run-1c', source_name, target_table, file_path, checksum_md5, source_rows, valid_rows, quarantined_rows,
  0, valid_rows, 'SKIPPED_ALREADY_LOADED', '2026-05-02 02:00:00' from files where m%6=0
) y
"""

COUNTRIES_SQL = """
select r_regionkey as id, 'c'||cast(r_regionkey as string) as code, r_name as name, 'R'||cast(r_regionkey as string) as continent,
 'wiki/'||r_name as wikipedia_link, case when r_regionkey%2=0 then null else lower(r_name) end as keywords from region
"""

REGIONS_SQL = """
select n_nationkey as id, 'c'||cast(n_regionkey as string)||'-'||cast(n_nationkey as string) as code, cast(n_nationkey as string) as local_code, n_name as name,
 'R'||cast(n_regionkey as string) as continent, 'c'||cast(n_regionkey as string) as iso_country, 'wiki/'||n_name as wikipedia_link,
 case when n_nationkey%2=0 then null else lower(n_name) end as keywords from nation
"""

BOOKINGS_FILE = "landing/bookings/bookings.csv"
PAYMENTS_FILE = "landing/payments/payments.csv"
LOADED_AT = "2026-05-01 00:00:00"
RUN_ID = "run-2"


def present(df: DataFrame) -> DataFrame:
    """Money as double, doubles to six places, dates and times as text: one form for both engines."""
    out: list[Column] = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c, 6)
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        out.append(c.alias(f.name))
    return df.select(*out)


def _loaded_at() -> Column:
    return F.lit(LOADED_AT).cast("timestamp_ntz").alias("loaded_at")


_stored: dict[tuple[str, str, str], str] = {}


def stored(layer: str):
    """A table that is written to the work folder once per session, then read from there.

    Sources are landed and checked tables are loaded before anything is modelled on them; this keeps the
    plans downstream small and lets column pruning and filters reach a Parquet scan. Each task writes the rows
    that it has: dealing them out anew would sort and shuffle the whole table for nothing.
    """

    def wrap(build):
        name = build.__name__

        def get(self) -> DataFrame:
            slot = (self.spark.sparkContext.applicationId, self.sf_dir, name)
            if slot not in _stored:
                root = work_folder(self.spark, "tables")
                tables.write_table(build(self), root, layer, name)
                _stored[slot] = root
            return tables.read_table(self.spark, _stored[slot], layer, name)

        get.__name__, get.__doc__ = name, build.__doc__
        wrapped = cached_property(get)
        return wrapped

    return wrap


class Tables:
    """Every table of the warehouse as a lazy DataFrame over one folder of given tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)

    def given(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def sql(self, text: str, *given: str, **derived: DataFrame) -> DataFrame:
        for name in given:
            self.given(name).createOrReplaceTempView(name)
        for name, df in derived.items():
            df.createOrReplaceTempView(name)
        return self.spark.sql(text)

    # Sources, every column as text ------------------------------------------------------------

    @stored("source")
    def bookings(self) -> DataFrame:
        """Each record has a unique number that follows file order: a replay comes after its original."""
        number = (F.col("k") * 2 + F.col("dup") + 2).alias("row_number")
        columns = [name for name in schemas.RAW_BOOKINGS if name not in ("route", "created_at")]
        return self.sql(BOOKINGS_SQL, "orders").select(
            *columns,
            F.concat_ws("-", "origin_airport", "destination_airport").alias("route"),
            F.col("booking_time").alias("created_at"),
            number,
            F.lit(BOOKINGS_FILE).alias("file_path"),
            "k",
            "dup",
        )

    @stored("source")
    def payments(self) -> DataFrame:
        number = (F.col("k") * 2 + F.col("dup") + 2).alias("row_number")
        return self.sql(f"with bk as ({BOOKINGS_SQL}) {PAYMENTS_SQL}", "orders").select(
            *schemas.RAW_PAYMENTS, number, F.lit(PAYMENTS_FILE).alias("file_path"), "k", "dup"
        )

    @stored("source")
    def flights(self) -> DataFrame:
        """Flight records under their source names, as text."""
        df = self.sql(FLIGHTS_SQL, "lineitem")
        return df.select(*[F.col(name).cast("string").alias(name) for name in df.columns])

    @cached_property
    def airports(self) -> DataFrame:
        return self.sql(AIRPORTS_SQL, "nation")

    @stored("source")
    def messages(self) -> DataFrame:
        return self.sql(MESSAGES_SQL, "events").select(
            "topic", "partition", "kafka_offset", F.lit(None).cast("string").alias("key"), "value"
        )

    # Validation -------------------------------------------------------------------------------

    @cached_property
    def checked_bookings(self) -> quality.Validated:
        return quality.validate_bookings(self.bookings)

    @cached_property
    def checked_payments(self) -> quality.Validated:
        return quality.validate_payments(self.payments, self.checked_bookings.valid)

    @stored("metadata")
    def dq_errors(self) -> DataFrame:
        found = self.checked_bookings.errors.unionByName(self.checked_payments.errors)
        empty = found.limit(0)
        return audit.persist_errors(found, RUN_ID, empty)

    @stored("quarantine")
    def quarantine(self) -> DataFrame:
        return self.quarantine_rows()

    def quarantine_rows(self) -> DataFrame:
        out = None
        for checked in (self.checked_bookings, self.checked_payments):
            rows = checked.quarantine.drop("k", "dup")
            empty = self.spark.createDataFrame([], "quarantine_id string")
            stored = audit.persist_quarantine(rows, RUN_ID, checked.source_name, empty)
            out = stored if out is None else out.unionByName(stored)
        return out.withColumn("created_at", F.lit(LOADED_AT).cast("timestamp_ntz"))

    @cached_property
    def file_profiles(self) -> DataFrame:
        """Source, size and missing columns of the four sources, from the tables themselves."""
        out = None
        for source, df in (
            ("bts", self.flights),
            ("airports", self.airports),
            ("bookings", self.bookings),
            ("payments", self.payments),
        ):
            wanted = F.array(*[F.lit(c) for c in sorted(schemas.REQUIRED_COLUMNS[source])])
            held = F.array(*[F.lit(c) for c in df.columns])
            one = df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(source).alias("source_name"),
                F.lit(f"landing/{source}/{source}.csv").alias("file_path"),
                F.md5(F.concat_ws("|", F.lit(source), "row_count")).alias("checksum_md5"),
                (F.col("row_count") * 100).alias("file_size_bytes"),
                "row_count",
                F.array_except(wanted, held).alias("missing_columns"),
            )
            out = one if out is None else out.unionByName(one)
        return out.withColumn(
            "status",
            F.when((F.size("missing_columns") > 0) | (F.col("row_count") == 0), "FAILED").otherwise("PASSED"),
        )

    @stored("metadata")
    def report(self) -> DataFrame:
        return self.report_rows()

    def report_rows(self) -> DataFrame:
        return quality.quality_report(self.file_profiles, [self.checked_bookings, self.checked_payments])

    @cached_property
    def raw_counts(self) -> DataFrame:
        """Rows of each raw table."""
        out = None
        for source, table in (
            ("bts", self.raw_flights),
            ("airports", self.raw_airports),
            ("bookings", self.raw_bookings),
            ("payments", self.raw_payments),
        ):
            one = table.agg(F.count(F.lit(1)).alias("actual_raw_rows")).select(
                F.lit(source).alias("source_name"),
                F.lit(f"raw.{schemas.RAW_TABLE_OF[source]}").alias("target_table"),
                "actual_raw_rows",
            )
            out = one if out is None else out.unionByName(one)
        return out

    @cached_property
    def reconciliation(self) -> DataFrame:
        """Two runs: the earlier one saw the bookings before orphans and rejects were taken out."""
        now = audit.reconcile(self.report, self.raw_counts, RUN_ID).withColumn(
            "created_at", F.lit("2026-05-02 00:00:00").cast("timestamp_ntz")
        )
        everything = self.file_profiles.withColumns({"quarantined_rows": F.lit(0), "valid_rows": F.col("row_count")})
        before = audit.reconcile(everything, self.raw_counts, "run-1").withColumn(
            "created_at", F.lit("2026-05-01 00:00:00").cast("timestamp_ntz")
        )
        return now.unionByName(before)

    # Load control -----------------------------------------------------------------------------

    @cached_property
    def delivered_files(self) -> DataFrame:
        return self.sql(FILES_SQL, "orders")

    @cached_property
    def load_history(self) -> DataFrame:
        return self.sql(LOAD_HISTORY_SQL, files=self.delivered_files).withColumn(
            "completed_at", F.col("completed_at").cast("timestamp")
        )

    @cached_property
    def load_audit(self) -> DataFrame:
        at = F.lit("2026-05-03 01:00:00").cast("timestamp")
        loads = audit.load_outcomes(self.delivered_files, self.load_history)
        return audit.audit_rows(RUN_ID, loads, self.load_history, at)

    # Raw tables -------------------------------------------------------------------------------

    @stored("raw")
    def raw_flights(self) -> DataFrame:
        named = files.project_raw(self.flights, schemas.FLIGHT_COLUMNS, schemas.RAW_FLIGHTS)
        return files.typed(named, schemas.RAW_FLIGHTS).select("*", _loaded_at())

    @cached_property
    def raw_airports(self) -> DataFrame:
        named = files.project_raw(self.airports, {}, schemas.RAW_AIRPORTS)
        return files.typed(named.withColumn("id", F.col("id").cast("string")), schemas.RAW_AIRPORTS).select(
            "*", _loaded_at()
        )

    @cached_property
    def raw_countries(self) -> DataFrame:
        return self._reference("countries", self.sql(COUNTRIES_SQL, "region"), schemas.RAW_COUNTRIES)

    @cached_property
    def raw_regions(self) -> DataFrame:
        return self._reference("regions", self.sql(REGIONS_SQL, "nation"), schemas.RAW_REGIONS)

    def _reference(self, source: str, df: DataFrame, types: dict[str, str]) -> DataFrame:
        """A raw reference table with the file that its rows came from."""
        text = files.project_raw(df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]), {}, types)
        file = F.lit(f"landing/{source}/{source}.csv").alias("source_file")
        return files.typed(text, types).select("*", file, _loaded_at())

    @stored("raw")
    def raw_bookings(self) -> DataFrame:
        return files.typed(self.checked_bookings.valid, schemas.RAW_BOOKINGS).select("*", _loaded_at())

    @stored("raw")
    def raw_payments(self) -> DataFrame:
        return files.typed(self.checked_payments.valid, schemas.RAW_PAYMENTS).select("*", _loaded_at())

    # Models -----------------------------------------------------------------------------------

    @cached_property
    def stg_flights(self) -> DataFrame:
        return staging.stg_flights(self.raw_flights)

    @cached_property
    def stg_airports(self) -> DataFrame:
        return staging.stg_airports(self.raw_airports)

    @cached_property
    def stg_bookings(self) -> DataFrame:
        return staging.stg_bookings(self.raw_bookings)

    @cached_property
    def stg_payments(self) -> DataFrame:
        return staging.stg_payments(self.raw_payments)

    @cached_property
    def dim_airport(self) -> DataFrame:
        return models.dim_airport(self.stg_airports)

    @cached_property
    def fact_flight_status(self) -> DataFrame:
        return models.fact_flight_status(self.stg_flights)

    @cached_property
    def fact_booking(self) -> DataFrame:
        return models.fact_booking(self.stg_bookings)

    @cached_property
    def fact_payment(self) -> DataFrame:
        return models.fact_payment(self.stg_payments)

    @cached_property
    def int_route_daily(self) -> DataFrame:
        return models.int_route_daily(self.fact_flight_status)

    @cached_property
    def int_flight_booking_bridge(self) -> DataFrame:
        return models.int_flight_booking_bridge(self.fact_booking)

    @cached_property
    def int_customer_booking(self) -> DataFrame:
        return models.int_customer_booking(self.fact_booking)

    @cached_property
    def mart_sales_performance(self) -> DataFrame:
        return marts.mart_sales_performance(self.fact_booking)

    @cached_property
    def mart_booking_status_realtime(self) -> DataFrame:
        return marts.mart_booking_status_realtime(self.fact_booking)

    @cached_property
    def mart_booking_trend_daily(self) -> DataFrame:
        return marts.mart_booking_trend_daily(self.fact_booking)

    @cached_property
    def mart_route_performance(self) -> DataFrame:
        return marts.mart_route_performance(self.int_route_daily, self.int_flight_booking_bridge)

    @cached_property
    def mart_airport_performance(self) -> DataFrame:
        return marts.mart_airport_performance(self.fact_flight_status, self.dim_airport)

    @cached_property
    def mart_customer_segment(self) -> DataFrame:
        return marts.mart_customer_segment(self.int_customer_booking)

    @cached_property
    def mart_flight_delay_analysis(self) -> DataFrame:
        return marts.mart_flight_delay_analysis(self.fact_flight_status)

    @cached_property
    def feat_route_delay(self) -> DataFrame:
        return features.feat_route_delay(self.flights)

    @cached_property
    def feat_route_booking(self) -> DataFrame:
        return features.feat_route_booking(self.bookings)

    # Stream tables, from the messages as one batch ----------------------------------------------

    @cached_property
    def envelopes(self) -> DataFrame:
        return st_validate_envelope(self.messages)

    def stream_table(self, topic: str) -> DataFrame:
        landed = landing.first_deliveries(landing.st_route_topic(self.envelopes, topic))
        return landed.withColumn("ingested_at", F.lit(LOADED_AT).cast("timestamp"))

    @cached_property
    def stream_tables(self) -> dict[str, DataFrame]:
        tables = {table: self.stream_table(topic) for topic, table in STREAM_TABLES.items()}
        return tables | {landing.DLQ_TABLE: landing.dead_letters(self.envelopes)}
