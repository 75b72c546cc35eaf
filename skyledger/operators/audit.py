"""Load control: what to load, what was loaded, and whether the counts agree."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import md5_id, row_json
from ..schemas import FILE_REGISTRY, LOAD_AUDIT, RUN_LOG
from ..sources.tables import written
from .dedupe import keep_first
from .incremental import insert_missing, upsert

if TYPE_CHECKING:
    from ..sources.versions import Transaction, Warehouse

LOADED, SKIPPED = "LOADED", "SKIPPED_ALREADY_LOADED"
AUDIT_UPDATE = ["inserted_rows", "skipped_rows", "load_status", "completed_at", "error_message"]
REGISTRY_UPDATE = ["row_count", "checksum_md5", "load_status", "completed_at", "error_message"]
RUN_UPDATE = ["total_input_rows", "total_loaded_rows", "dbt_status", "test_status"]
AUDIT_TABLE, REGISTRY_TABLE, RUN_TABLE = "metadata/load_audit", "metadata/file_registry", "metadata/run_log"
BUCKETS = 64


def conform(df: DataFrame, schema: str) -> DataFrame:
    """Columns of a declared table, in order and type; absent ones are NULL."""
    out = []
    for field in schema.split(", "):
        name, kind = field.split(" ", 1)
        out.append((F.col(name) if name in df.columns else F.lit(None)).cast(kind).alias(name))
    return df.select(*out)


def loaded_slices(audit: DataFrame) -> DataFrame:
    """The content that each source slice (table and file) holds now: its latest load, skips included."""
    done = audit.where(F.col("load_status").isin(LOADED, SKIPPED))
    latest = keep_first(
        done, ["target_table", "file_path"], [F.col("completed_at").desc(), F.col("load_audit_id").desc()]
    )
    return latest.select("target_table", "file_path", "checksum_md5")


def files_to_load(profiles: DataFrame, audit: DataFrame) -> DataFrame:
    """Files whose slice does not hold the same content already."""
    return profiles.join(loaded_slices(audit), ["target_table", "file_path", "checksum_md5"], "left_anti")


def load_outcomes(profiles: DataFrame, audit: DataFrame) -> DataFrame:
    """Every file with its status and the rows to insert or skip."""
    held = loaded_slices(audit).withColumn("_held", F.lit(True))
    skip = F.coalesce(F.col("_held"), F.lit(False))
    return (
        profiles.join(held, ["target_table", "file_path", "checksum_md5"], "left")
        .withColumn("load_status", F.when(skip, SKIPPED).otherwise(LOADED))
        .withColumn("inserted_rows", F.when(skip, 0).otherwise(F.col("valid_rows")))
        .withColumn("skipped_rows", F.when(skip, F.col("valid_rows")).otherwise(0))
        .drop("_held")
    )


def audit_updates(run_id: str, loads: DataFrame, at: Column | None = None) -> DataFrame:
    """Audit rows of one run, one for each source, table and content."""
    when = F.current_timestamp() if at is None else at
    rows = loads.withColumns(
        {
            "run_id": F.lit(run_id),
            "started_at": when,
            "completed_at": when,
        }
    ).withColumn("load_audit_id", md5_id("run_id", "source_name", "target_table", "checksum_md5"))
    return keep_first(conform(rows, LOAD_AUDIT), ["load_audit_id"], [F.col("file_path").asc()])


def audit_rows(run_id: str, loads: DataFrame, audit: DataFrame, at: Column | None = None) -> DataFrame:
    """The audit table after this run; a row of the same run, source, table and content is updated."""
    return upsert(conform(audit, LOAD_AUDIT), audit_updates(run_id, loads, at), ["load_audit_id"], AUDIT_UPDATE)


def registry_updates(report: DataFrame, status: str = LOADED, at: Column | None = None) -> DataFrame:
    """Registry rows of a report, one per content."""
    when = F.current_timestamp() if at is None else at
    rows = report.withColumns(
        {
            "file_id": F.col("checksum_md5"),
            "partition_key": F.element_at(F.split("file_path", "/"), -2),
            "load_status": F.lit(status),
            "started_at": when,
            "completed_at": when,
            "error_message": F.nullif(F.array_join("missing_columns", "; "), F.lit("")),
        }
    )
    return keep_first(conform(rows, FILE_REGISTRY), ["file_id"], [F.col("file_path").asc()])


def register_files(report: DataFrame, registry: DataFrame, status: str = LOADED, at: Column | None = None) -> DataFrame:
    """The file registry after this report, one row per content."""
    return upsert(conform(registry, FILE_REGISTRY), registry_updates(report, status, at), ["file_id"], REGISTRY_UPDATE)


def run_summary(
    registry: DataFrame,
    run_id: str,
    dag_id: str = "manual",
    execution_date: Column | None = None,
    model_status: str = "SUCCESS",
    test_status: str = "SUCCESS",
) -> DataFrame:
    """The log row of a run: files and rows of the whole registry."""
    when = F.current_timestamp() if execution_date is None else execution_date
    rows = F.coalesce(F.sum("row_count"), F.lit(0))
    run = registry.agg(
        F.count(F.lit(1)).alias("source_count"),
        rows.alias("total_input_rows"),
        rows.alias("total_loaded_rows"),
    ).withColumns(
        {
            "run_id": F.lit(run_id),
            "dag_id": F.lit(dag_id),
            "execution_date": when,
            "dbt_status": F.lit(model_status),
            "test_status": F.lit(test_status),
            "created_at": F.current_timestamp(),
        }
    )
    return conform(run, RUN_LOG)


def run_log(registry: DataFrame, run_id: str, log: DataFrame, **state) -> DataFrame:
    """The run log after this run."""
    return upsert(conform(log, RUN_LOG), run_summary(registry, run_id, **state), ["run_id"], RUN_UPDATE)


def persist_errors(errors: DataFrame, run_id: str, target: DataFrame) -> DataFrame:
    """Error rows to append: those this run has not stored yet, the earliest rule's where ids are equal."""
    rows = errors.withColumns({"run_id": F.lit(run_id), "error_id": md5_id(F.lit(run_id), "error_id")})
    return insert_missing(target, rows, ["error_id"], [F.col("place").asc()]).drop("place")


def persist_quarantine(rows: DataFrame, run_id: str, source_name: str, target: DataFrame) -> DataFrame:
    """Quarantined rows to append, each with the whole row as JSON."""
    raw = [name for name in rows.columns if name != "file_path"]
    out = rows.select(
        md5_id(F.lit(run_id), F.lit(source_name), "file_path", "row_number", "record_key").alias("quarantine_id"),
        F.lit(run_id).alias("run_id"),
        F.lit(source_name).alias("source_name"),
        "file_path",
        "row_number",
        "record_key",
        "reason",
        row_json(*raw).alias("raw_record"),
    )
    return insert_missing(target, out, ["quarantine_id"])


def load(
    rows: DataFrame, profiles: DataFrame, target: DataFrame, history: DataFrame, run_id: str, at: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """One raw table and the audit after a load of delivered files.

    What the target already holds is skipped. The rows of every other file take the place of those
    that the target has of the same ``file_path``, also when none are left.
    """
    outcomes = load_outcomes(profiles, history)
    changed = outcomes.where(F.col("load_status") == LOADED).select("file_path")
    kept = target.join(changed, "file_path", "left_anti").select(*target.columns)
    new = rows.join(changed, "file_path", "left_semi").select(*target.columns)
    return kept.unionByName(new), audit_rows(run_id, outcomes, history, at)


def _keyed(change: Transaction, name: str, schema: str, keys: list[str]) -> None:
    if change.table(name) is None:
        change.create(name, schema, keys, BUCKETS)


def record_loads(change: Transaction, run_id: str, loads: DataFrame, at: Column | None = None) -> list[int]:
    """Merge the audit rows of a run into the stored audit; returns the buckets that were written."""
    _keyed(change, AUDIT_TABLE, LOAD_AUDIT, ["load_audit_id"])
    return change.merge(AUDIT_TABLE, audit_updates(run_id, loads, at), AUDIT_UPDATE)


def record_files(change: Transaction, report: DataFrame, status: str = LOADED, at: Column | None = None) -> list[int]:
    """Merge a report into the stored file registry."""
    _keyed(change, REGISTRY_TABLE, FILE_REGISTRY, ["file_id"])
    return change.merge(REGISTRY_TABLE, registry_updates(report, status, at), REGISTRY_UPDATE)


def record_run(change: Transaction, registry: DataFrame, run_id: str, **state) -> list[int]:
    """Merge the summary of a run into the stored run log."""
    _keyed(change, RUN_TABLE, RUN_LOG, ["run_id"])
    return change.merge(RUN_TABLE, run_summary(registry, run_id, **state), RUN_UPDATE)


def load_files(
    house: Warehouse, table: str, rows: DataFrame, profiles: DataFrame, run_id: str, at: Column | None = None
) -> DataFrame:
    """Load delivered files into a stored raw table, and their audit, in one commit; the outcome of each file.

    What the table already holds is skipped. The rows of every other file take the place of those that the table has
    of the same ``file_path``; only buckets with such a file are read and written. The run's label makes a rerun
    of a committed load change nothing.
    """
    change = house.begin()
    if change.table(table) is None:
        change.create(table, rows.schema, ["file_path"], BUCKETS)
    _keyed(change, AUDIT_TABLE, LOAD_AUDIT, ["load_audit_id"])
    outcomes = written(load_outcomes(profiles, change.read(AUDIT_TABLE)), "load-outcomes")
    changed = outcomes.where(F.col("load_status") == LOADED).select("file_path")
    change.replace_keys(table, changed, rows.join(changed, "file_path", "left_semi"))
    record_loads(change, run_id, outcomes, at)
    change.commit(f"{run_id}|{table}")
    return outcomes


def file_counts(raw: DataFrame, source_name: str, target_table: str) -> DataFrame:
    """Rows that a raw table holds of each source file."""
    return raw.groupBy("file_path").agg(F.count(F.lit(1)).alias("actual_raw_rows")).select(
        F.lit(source_name).alias("source_name"), F.lit(target_table).alias("target_table"), "file_path", "actual_raw_rows"
    )


def reconcile(
    report: DataFrame, raw_counts: DataFrame, run_id: str, by: tuple[str, ...] = ("source_name",)
) -> DataFrame:
    """Expected against actual raw rows per source, or per file with ``by=("source_name", "file_path")``.

    ``raw_counts`` has the columns of ``by`` and ``target_table, actual_raw_rows``; a source without any is zero.
    """
    difference = F.col("actual_raw_rows") - F.col("expected_raw_rows")
    return (
        report.join(raw_counts, list(by), "left")
        .select(
            F.lit(run_id).alias("run_id"),
            *by,
            F.col("row_count").alias("source_file_rows"),
            "quarantined_rows",
            F.coalesce("valid_rows", "row_count").alias("expected_raw_rows"),
            F.coalesce("actual_raw_rows", F.lit(0)).alias("actual_raw_rows"),
            "target_table",
        )
        .withColumn("difference", difference)
        .withColumn("status", F.when(F.col("difference") == 0, "PASSED").otherwise("FAILED"))
        .withColumn("reconciliation_id", md5_id("run_id", *by, "target_table"))
    )


def require_reconciled(reconciliation: DataFrame) -> None:
    """Raise when the counts of any source differ, naming at most the first hundred."""
    rows = [r.asDict() for r in reconciliation.where(F.col("status") != "PASSED").limit(100).collect()]
    if rows:
        raise ValueError(f"Reconciliation failed: {rows}")


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The same rows, and their number once an action has run."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen
