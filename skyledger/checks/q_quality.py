"""Record rules, quarantine, error log, profiles and the quality report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import audit, quality, rules
from ..session import work_folder
from ..sources.tables import written
from ..sources.versions import Warehouse
from .fixtures import RUN_ID, Tables
from .oracle import dirty
from .registry import register

_FINDING = ["error_id", "source_name", "row_number", "record_key", "severity", "rule_name", "column_name",
            "bad_value", "error_message", "action_taken"]
_SQL_FINDING = ", ".join(_FINDING)


def _findings(t: Tables, name: str):
    """The log of one rule over both sources."""
    out = None
    for df, key, source, checks in (
        (t.bookings, "booking_id", "bookings", quality.booking_rules()),
        (t.payments, "payment_id", "payments", quality.payment_rules()),
    ):
        chosen = [rule for rule in checks if rule.name == name]
        if chosen:
            log = rules.error_log(df, chosen, key, source, F.col("file_path"))
            out = log if out is None else out.unionByName(log)
    return out.select(*_FINDING)


for _rule in (
    "required_not_null",
    "valid_date",
    "valid_numeric",
    "controlled_vocabulary",
    "standardization_required",
    "negative_value",
    "missing_optional",
    "refund_status_mismatch",
):
    register(f"dq_{_rule}", f"select {_SQL_FINDING} from dq_log where rule_name='{_rule}'")(
        lambda t, rule=_rule: _findings(t, rule)
    )


@register("dq_duplicate_event", f"select {_SQL_FINDING} from dq_log where rule_name='duplicate_event'")
def _(t: Tables):
    again = [
        rules.log_rows(quality.duplicate_event(df, key, f"Duplicate {what} event"), f"{what}s")
        for df, key, what in ((t.bookings, "booking_id", "booking"), (t.payments, "payment_id", "payment"))
    ]
    return again[0].unionByName(again[1]).select(*_FINDING)


@register(
    "dq_relationship_missing",
    """select row_number, booking_id, 'kept' as outcome from p_kept union all select row_number, booking_id, 'orphaned' from p_orphan""",
)
def _(t: Tables):
    valid = rules.valid_rows(t.payments, quality.payment_rules())
    found = quality.with_parent(valid, t.checked_bookings.valid, "booking_id")
    return found.select("row_number", "booking_id", F.when(F.col("has_parent"), "kept").otherwise("orphaned").alias("outcome"))


@register(
    "dq_split_valid_invalid",
    """select row_number, case when q.record_key is null then '' else q.record_key end as record_key, ifnull(q.reason,'') as reason
from bookings left join (select * from quarantined where source_name='bookings') q using (row_number)""",
)
def _(t: Tables):
    valid, quarantine = rules.split(t.bookings, quality.booking_rules(), "booking_id")
    clean = valid.select("row_number", F.lit("").alias("record_key"), F.lit("").alias("reason"))
    return clean.unionByName(quarantine.select("row_number", "record_key", "reason"))


register("dq_error_log", f"select {_SQL_FINDING} from dq_log")(
    lambda t: t.checked_bookings.errors.unionByName(t.checked_payments.errors).select(*_FINDING)
)


@register(
    "dq_record_key",
    """select 'bookings' as source_name, row_number, rk as record_key from b_keyed
union all select 'payments', row_number, rk from p_keyed""",
)
def _(t: Tables):
    parts = [
        df.select(F.lit(source).alias("source_name"), "row_number", rules.record_key(key).alias("record_key"))
        for df, key, source in ((t.bookings, "booking_id", "bookings"), (t.payments, "payment_id", "payments"))
    ]
    return parts[0].unionByName(parts[1])


_PROFILE_B = f"""select count(*) filter (where booking_id<>'')-count(distinct case when booking_id<>'' then upper(trim(booking_id)) end) as duplicate_booking_id_rows,
 count(*) filter (where {' or '.join(dirty(c) for c in ('booking_status', 'payment_status', 'booking_channel', 'origin_airport', 'destination_airport'))}) as dirty_standardization_rows,
 count(*) filter (where try_cast(ticket_price as double)<0) as negative_ticket_rows, count(*) filter (where trim(customer_id)='') as missing_customer_rows,
 count(*) filter (where updated_at<created_at) as out_of_order_update_rows from bookings"""
_PROFILE_P = f"""select count(*) filter (where payment_id<>'')-count(distinct case when payment_id<>'' then upper(trim(payment_id)) end) as duplicate_payment_id_rows,
 count(*) filter (where {' or '.join(dirty(c) for c in ('payment_status', 'payment_method', 'currency'))}) as dirty_standardization_rows,
 count(*) filter (where try_cast(amount as double)<0) as negative_amount_rows,
 count(*) filter (where try_cast(refund_amount as double)>0 and not contains(upper(payment_status),'REFUND')) as refund_without_refund_status_rows from payments"""

register("dq_profile_bookings", _PROFILE_B)(lambda t: quality.profile_bookings(t.bookings))
register("dq_profile_payments", _PROFILE_P)(lambda t: quality.profile_payments(t.payments))


@register(
    "dq_schema_gate",
    """select * from (select 'payments_cut' as source_name, (select count(*) from payments) as row_count, 'amount' as missing
 union all select 'no_such_topic', (select count(*) from messages where topic='no_such_topic'), '') z where missing<>'' or row_count=0""",
)
def _(t: Tables):
    """Sources that must stop a run: payments without their amounts, and a topic without messages."""
    cut = t.payments.drop("amount")
    held = F.array(*[F.lit(name) for name in cut.columns])
    wanted = F.array(*[F.lit(name) for name in ("amount", "booking_id", "payment_id", "payment_status")])
    none = F.array().cast("array<string>")
    sources = [
        (cut, "payments_cut", F.array_except(wanted, held)),
        (t.bookings, "bookings", none),
        (t.messages.where("topic = 'no_such_topic'"), "no_such_topic", none),
    ]
    report = None
    for df, name, missing in sources:
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("source_name"), "row_count", missing.alias("missing_columns")
        )
        report = one if report is None else report.unionByName(one)
    return quality.gate_failures(report).select(
        "source_name", "row_count", F.array_join("missing_columns", ",").alias("missing")
    )


@register(
    "dq_report",
    """select source_name, row_count, row_count*100 as file_size_bytes, valid_rows, quarantined_rows, record_error_rows, '' as missing, 'PASSED' as status,
 case source_name when 'bookings' then (select dirty_standardization_rows from prof_b) when 'payments' then (select dirty_standardization_rows from prof_p) end as dirty_rows
from outcomes""",
    prof_b=_PROFILE_B,
    prof_p=_PROFILE_P,
)
def _(t: Tables):
    return t.report_rows().select(
        "source_name", "row_count", "file_size_bytes", "valid_rows", "quarantined_rows", "record_error_rows",
        F.array_join("missing_columns", ",").alias("missing"), "status",
        F.get_json_object("quality_profile", "$.dirty_standardization_rows").cast("bigint").alias("dirty_rows"),
    )


def numbered(named: DataFrame, block: int = 20_000) -> DataFrame:
    """Number the bookings of each file in order of ``k`` and ``dup``, from 2 on.

    Bookings are counted by file and block of ``k``, a running sum over the blocks of a file gives the number that each
    block starts at, and a booking adds its place within its block: no task sorts a whole file.
    """
    placed, group = named.withColumn("_block", F.expr(f"k div {block}")), ["file_path", "_block"]
    counts = written(placed.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")), "numbers")
    before = Window.partitionBy("file_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*group, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy(*group).orderBy("k", "dup"))
    found = placed.withColumn("_place", place).join(starts, group)
    return found.withColumn("row_number", F.col("_start") + F.col("_place") + 1).select(*named.columns)


@register(
    "dq_several_files",
    """select file_path, case when (k, dup) in (select (k, dup) from b_valid) then 'valid' else 'quarantined' end as outcome, count(*) as n, sum(number)::bigint as numbers from parts group by 1, 2
 union all select file_path, 'repeated', count(*), sum(number)::bigint from (select *, row_number() over (partition by rk order by file_path, number) as nth from parts where trim(booking_id)<>'') z where nth>1 group by 1
 union all select file_path, 'reconciled', count(*), sum(case when (k, dup) in (select (k, dup) from b_valid) then 1 else 0 end)::bigint from parts group by 1""",
    parts="select k, dup, booking_id, rk, 'landing/bookings/part-'||(k%4)||'.csv' as file_path, row_number() over (partition by k%4 order by k, dup)+1 as number from b_keyed",
)
def _(t: Tables):
    """Four files whose records are numbered anew in each: what is valid, quarantined and repeated, told apart by file and number."""
    named = t.bookings.withColumn("file_path", F.concat(F.lit("landing/bookings/part-"), F.col("k") % 4, F.lit(".csv")))
    rows = written(numbered(named), "several-files")
    checked = quality.validate_bookings(rows)
    again = quality.duplicate_event(rows, "booking_id", "again")
    out = None
    for df, outcome in ((checked.valid, "valid"), (checked.quarantine, "quarantined"), (again, "repeated")):
        one = df.groupBy("file_path").agg(F.lit(outcome).alias("outcome"), F.count(F.lit(1)).alias("n"), F.sum("row_number").alias("numbers"))
        out = one if out is None else out.unionByName(one)
    report = rows.groupBy("file_path").agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit("bookings").alias("source_name"), "file_path", "row_count", F.lit(0).alias("quarantined_rows"), F.col("row_count").alias("valid_rows")
    )
    counts = audit.file_counts(checked.valid, "bookings", "raw.raw_bookings")
    found = audit.reconcile(report, counts, RUN_ID, by=("source_name", "file_path"))
    return out.unionByName(found.select("file_path", F.lit("reconciled").alias("outcome"), F.col("source_file_rows").alias("n"), F.col("actual_raw_rows").alias("numbers")))


# Persisting ------------------------------------------------------------------------------------------


@register(
    "dq_persist_errors",
    f"select error_id, '{RUN_ID}' as run_id, rule_name, record_key, column_name from dq_stored",
)
def _(t: Tables):
    """The bookings' errors are stored; then the run stores those of both sources, which adds the payments' only.

    An id holds the run's id, so only that run's partition is compared.
    """
    house, name = Warehouse(t.spark, work_folder(t.spark, "stored")), "metadata/dq_record_errors"
    errors = written(t.checked_bookings.errors.unionByName(t.checked_payments.errors), "errors")
    change = house.begin()
    change.replace(name, audit.persist_errors(errors.where("source_name = 'bookings'"), RUN_ID, errors.limit(0)), ["run_id"])
    change.commit()
    change = house.begin()
    mine = house.read(name, where=lambda part: part == f"run_id={RUN_ID}")
    change.append(name, audit.persist_errors(errors, RUN_ID, mine))
    change.commit()
    return house.read(name).select("error_id", "run_id", "rule_name", "record_key", "column_name")


@register(
    "dq_persist_quarantine",
    f"""select q.quarantine_id, q.run_id, q.source_name, q.row_number, q.record_key, q.reason, coalesce(b.ticket_price,p.amount) as raw_value
from quarantined q left join bookings b on q.source_name='bookings' and q.row_number=b.row_number
left join payments p on q.source_name='payments' and q.row_number=p.row_number""",
)
def _(t: Tables):
    raw = F.coalesce(
        F.get_json_object("raw_record", "$.ticket_price"), F.get_json_object("raw_record", "$.amount")
    )
    return t.quarantine_rows().select(
        "quarantine_id", "run_id", "source_name", "row_number", "record_key", "reason", raw.alias("raw_value")
    )


