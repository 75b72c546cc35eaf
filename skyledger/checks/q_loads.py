"""Load control, audit, reconciliation and upserts."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas
from ..operators import audit, incremental
from ..session import work_folder
from ..sources.versions import Warehouse
from .fixtures import COUNTRIES_SQL, REGIONS_SQL, RUN_ID, Tables
from .registry import register


@register(
    "ld_checksum_skip",
    "select file_path, checksum_md5, row_count from loads where load_status='LOADED'",
)
def _(t: Tables):
    return audit.files_to_load(t.delivered_files, t.load_history).select("file_path", "checksum_md5", "row_count")


_SLICED = """select o_orderkey as id, o_orderpriority as kind, case o_orderstatus when 'O' then 'landing/generated/bookings/a.csv'
 when 'F' then 'landing/validated/bookings/b.csv' else 'landing/other/c.csv' end as source_file from orders"""


def _slices(t: Tables):
    target = t.sql(_SLICED, "orders")
    new = target.where("kind = '1-URGENT'").withColumn("source_file", F.lit("landing/validated/bookings/b.csv"))
    return target, new.withColumn("id", F.col("id") + 1_000_000_000)


_NEW_SLICE = """select id+1000000000 as id, kind, 'landing/validated/bookings/b.csv' as source_file from sliced where kind='1-URGENT'"""


@register(
    "ld_slice_replace",
    f"select * from sliced where source_file='landing/other/c.csv' union all {_NEW_SLICE}",
    sliced=_SLICED,
)
def _(t: Tables):
    target, new = _slices(t)
    patterns = ["%/generated/bookings/%", "%/validated/bookings/%"]
    return incremental.replace_slice(target, new, "source_file", patterns)


@register(
    "ld_slice_replace_exact",
    f"select * from sliced where source_file<>'landing/validated/bookings/b.csv' union all {_NEW_SLICE}",
    sliced=_SLICED,
)
def _(t: Tables):
    target, new = _slices(t)
    return incremental.replace_slice(target, new, "source_file")


@register("ld_audit", "select * from audit_after")
def _(t: Tables):
    """The stored audit after a run is merged into it."""
    house = Warehouse(t.spark, work_folder(t.spark, "audit"))
    history = house.begin()
    history.create(audit.AUDIT_TABLE, schemas.LOAD_AUDIT, ["load_audit_id"], audit.BUCKETS)
    history.merge(audit.AUDIT_TABLE, audit.conform(t.load_history, schemas.LOAD_AUDIT), audit.AUDIT_UPDATE)
    history.commit()
    change = house.begin()
    loads = audit.load_outcomes(t.delivered_files, change.read(audit.AUDIT_TABLE))
    audit.record_loads(change, RUN_ID, loads, F.lit("2026-05-03 01:00:00").cast("timestamp"))
    change.commit(RUN_ID)
    return house.read(audit.AUDIT_TABLE).drop("file_path", "started_at", "error_message")


_REGISTRY = """select checksum_md5 as file_id, source_name, file_path, regexp_extract(file_path,'([^/]+)/[^/]+$',1) as partition_key, file_size_bytes::bigint as file_size_bytes,
 row_count, checksum_md5, 'LOADED' as load_status, null::varchar as error_message from files"""


@register("ld_registry_upsert", _REGISTRY)
def _(t: Tables):
    """Files of every third month are registered already, as loading and with no rows yet."""
    report = t.delivered_files.withColumn("missing_columns", F.array().cast("array<string>"))
    at = F.lit("2026-05-03 01:00:00").cast("timestamp")
    house = Warehouse(t.spark, work_folder(t.spark, "registry"))
    started = report.where("m % 3 = 0").withColumn("row_count", F.lit(0).cast("bigint"))
    for rows, status in ((started, "LOADING"), (report, "LOADED")):
        change = house.begin()
        audit.record_files(change, rows, status, at)
        change.commit()
    return house.read(audit.REGISTRY_TABLE).drop("started_at", "completed_at")


@register(
    "ld_run_log",
    """select 'run-1' as run_id, 'manual' as dag_id, 0::bigint as source_count, 0::bigint as total_input_rows, 'FAILED' as dbt_status, 'SUCCESS' as test_status, null::double as runtime_seconds
union all select 'run-2', 'manual', 0, sum(row_count)::bigint, 'SUCCESS', 'SUCCESS', null from files""",
)
def _(t: Tables):
    """Both runs are logged before any file is registered; then run-2 finishes."""
    nothing = t.spark.createDataFrame([], audit.FILE_REGISTRY)
    house = Warehouse(t.spark, work_folder(t.spark, "runs"))
    registry = audit.conform(t.delivered_files, audit.FILE_REGISTRY)
    for files, run, state in ((nothing, "run-1", "FAILED"), (nothing, RUN_ID, "FAILED"), (registry, RUN_ID, "SUCCESS")):
        change = house.begin()
        audit.record_run(change, files, run, model_status=state)
        change.commit()
    return house.read(audit.RUN_TABLE).drop("execution_date", "total_loaded_rows", "created_at")


#: Activity by customer; urgent orders are booked by walk-in accounts, which no customer has.
_ACTIVITY = """select case when o_orderpriority='1-URGENT' then o_custkey+1000000000 else o_custkey end as id, 'order '||cast(max(o_orderkey) as string) as name, 'ACTIVE' as segment, count(*) as n
 from orders group by case when o_orderpriority='1-URGENT' then o_custkey+1000000000 else o_custkey end"""


@register(
    "up_do_update",
    """select coalesce(c.c_custkey,a.id) as id, coalesce(c.c_name,a.name) as name, coalesce(a.segment,c.c_mktsegment) as segment, coalesce(a.n,0)::bigint as n
from customer c full join activity a on c.c_custkey=a.id""",
    activity=_ACTIVITY,
)
def _(t: Tables):
    """All customers, stored by bucket, then the activity of a first and a second half of the orders merged into them."""
    house = Warehouse(t.spark, work_folder(t.spark, "customers"))
    known = t.given("customer").selectExpr("c_custkey as id", "c_name as name", "c_mktsegment as segment", "0L as n")
    seen = t.sql(_ACTIVITY, "orders")
    first = house.begin()
    first.create("customers", known.schema, ["id"], 64)
    first.merge("customers", known, [])
    first.commit()
    for half in (0, 1):
        change = house.begin()
        change.merge("customers", seen.where(F.col("id") % 2 == half), ["segment", "n"])
        change.commit(f"half {half}")
    return house.read("customers")


@register(
    "up_do_nothing",
    """select user_id, min(event_id) filter (where buyer) as first_purchase, min(event_id) as first_event, bool_or(buyer) as buyer from (select *, event_type='purchase' and user_id%2=0 as buyer from events) e group by user_id""",
)
def _(t: Tables):
    """Buyers with an even id are stored; of all others that have events, one row each is added, and none is changed."""
    events = t.given("events").select("user_id", "event_id", "event_type")
    bought = events.where("event_type = 'purchase' and user_id % 2 = 0")
    house = Warehouse(t.spark, work_folder(t.spark, "users"))
    stored = bought.groupBy("user_id").agg(F.min("event_id").alias("event_id")).withColumn("buyer", F.lit(True))
    change = house.begin()
    change.create("users", stored.schema, ["user_id"], 16)
    change.merge("users", stored, [])
    for _run in range(2):
        change.merge("users", events.withColumn("buyer", F.lit(False)), [], [F.col("event_id").asc()], insert_only=True)
    change.commit()
    first = events.groupBy("user_id").agg(F.min("event_id").alias("first_event"))
    rows = house.read("users").join(first, "user_id", "full")
    return rows.select("user_id", F.when(F.col("buyer"), F.col("event_id")).alias("first_purchase"), F.when(F.col("buyer"), F.col("first_event")).otherwise(F.col("event_id")).alias("first_event"), "buyer")


@register(
    "rc_source_to_raw",
    """select md5(run_id||'|'||source_name||'|'||target_table) as reconciliation_id, run_id, source_name, target_table, source_file_rows, quarantined_rows,
 expected_raw_rows, actual_raw_rows, difference, status from recon where run_id='run-2'""",
)
def _(t: Tables):
    return audit.reconcile(t.report, t.raw_counts, RUN_ID)


@register(
    "ld_load_files",
    """select file_path, n as expected_raw_rows, actual as actual_raw_rows, case when n=actual then 'PASSED' else 'FAILED' end as status,
 case when part=0 then 'SKIPPED_ALREADY_LOADED' else 'LOADED' end as load_status, case when part=0 then 0 else n end as inserted_rows, case when part=0 then n else 0 end as skipped_rows, 4::bigint as audit_rows
from (select k%4 as part, 'landing/bookings/part-'||(k%4)||'.csv' as file_path, count(*) as n, count(*) filter (where k%4<>0 or dup=0) as actual from bookings group by 1, 2) z""",
)
def _(t: Tables):
    """Four files into one raw table: part 0 counts as held and is skipped, 1 and 3 are reloaded, 2 is new.

    Part 0 is held without its replays, so where it has any, its counts differ. Rows and audit are committed together,
    and the second call of the run changes nothing.
    """
    part = F.concat(F.lit("landing/bookings/part-"), F.col("k") % 4, F.lit(".csv"))
    rows = t.bookings.withColumn("file_path", part)
    old = rows.where("dup = 0 and k % 4 <> 2")
    zero = "part-0.csv"
    known = _profiles(rows).where(F.col("file_path").endswith(zero)).unionByName(
        _profiles(old).where(~F.col("file_path").endswith(zero))
    )
    times = [F.lit(f"2026-05-0{day} 00:00:00").cast("timestamp") for day in (1, 2)]
    house, raw = Warehouse(t.spark, work_folder(t.spark, "raw")), "raw/raw_bookings"
    audit.load_files(house, raw, old, known, "run-1", times[0])
    delivered = _profiles(rows)
    for _run in range(2):
        audit.load_files(house, raw, rows, delivered, RUN_ID, times[1])
    counts = audit.file_counts(house.read(raw), "bookings", "raw.raw_bookings")
    found = audit.reconcile(delivered.drop("target_table"), counts, RUN_ID, by=("source_name", "file_path"))
    log = house.read(audit.AUDIT_TABLE).where(F.col("run_id") == RUN_ID)
    total = log.agg(F.count(F.lit(1)).alias("audit_rows"))
    status = log.select("file_path", "load_status", "inserted_rows", "skipped_rows")
    return found.select("file_path", "expected_raw_rows", "actual_raw_rows", "status").join(status, "file_path").join(F.broadcast(total))


def _profiles(rows):
    number = F.concat_ws("|", F.count(F.lit(1)), F.sum("row_number"))
    one = rows.groupBy("file_path").agg(F.count(F.lit(1)).alias("row_count"), F.md5(number).alias("checksum_md5"))
    return one.select(
        F.lit("bookings").alias("source_name"), F.lit("raw.raw_bookings").alias("target_table"), "file_path",
        "checksum_md5", "row_count", F.col("row_count").alias("source_rows"), F.col("row_count").alias("valid_rows"),
        F.lit(0).cast("bigint").alias("quarantined_rows"),
    )


@register(
    "raw_countries",
    "select *, 'landing/countries/countries.csv' as source_file from countries",
    countries=COUNTRIES_SQL,
)
def _(t: Tables):
    return t.raw_countries.drop("loaded_at")


@register(
    "raw_regions",
    "select *, 'landing/regions/regions.csv' as source_file from regions",
    regions=REGIONS_SQL,
)
def _(t: Tables):
    return t.raw_regions.drop("loaded_at")


_INC = {
    "inc_old": "select k, 1+k%30 as day, ticket_price as price from bookings where dup=0",
    "inc_new": "select k, 1+(k+1)%30 as day, ticket_price as price from bookings where dup=1",
}


@register(
    "inc_delete_insert",
    """select * from inc_old where day not in (select day from inc_new) and k not in (select k from inc_new) union all select * from inc_new""",
    **_INC,
)
def _(t: Tables):
    old = t.bookings.where("dup = 0").selectExpr("k", "1 + k % 30 as day", "ticket_price as price")
    new = t.bookings.where("dup = 1").selectExpr("k", "1 + (k + 1) % 30 as day", "ticket_price as price")
    return incremental.delete_insert(old, new, "day", ["k"])


@register(
    "inc_merge_partitions",
    """select * from inc_old where day not in (select day from inc_new) and k not in (select k from inc_new) union all select * from inc_new""",
    **_INC,
)
def _(t: Tables):
    """The same on a published table: what is not touched is named by the new version as it is."""
    house = Warehouse(t.spark, work_folder(t.spark, "merged"))
    old = t.bookings.where("dup = 0").selectExpr("k", "1 + k % 30 as day", "ticket_price as price")
    new = t.bookings.where("dup = 1").selectExpr("k", "1 + (k + 1) % 30 as day", "ticket_price as price")
    for rows in (old, new):
        change = house.begin()
        change.delete_insert("bookings", rows, "day", ["k"])
        change.commit()
    return house.read("bookings")
