"""Quality of the booking and payment sources: rules, split, orphans, profiles, report and gate."""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dirty_token, is_blank, strip, token_trim_first
from ..functions.vocab import BOOKING_STATUS, PAYMENT_STATUS
from .dedupe import repeats
from .filters import key_lookup
from .rules import (
    Rule,
    _above_zero,
    _below_zero,
    breaks_any,
    controlled_vocabulary,
    key_scope,
    error_log,
    log_rows,
    missing_optional,
    negative_value,
    quarantined_rows,
    record_key,
    refund_status_mismatch,
    required_not_null,
    standardization_required,
    valid_date,
    valid_numeric,
    valid_rows,
)

ORPHAN = "Payment references a booking that failed booking DQ or is missing"


def booking_rules() -> list[Rule]:
    return [
        required_not_null("booking_id"),
        required_not_null("flight_id"),
        valid_date("flight_date"),
        valid_numeric("ticket_price"),
        controlled_vocabulary("booking_status", BOOKING_STATUS.spellings(), "STANDARDIZED_TO_PENDING"),
        controlled_vocabulary("payment_status", PAYMENT_STATUS.spellings(), "STANDARDIZED_TO_FAILED"),
        standardization_required(["booking_status", "booking_channel"]),
        negative_value("ticket_price", "Negative ticket price"),
        missing_optional("customer_id", "DEFAULT_UNKNOWN_CUSTOMER"),
    ]


def payment_rules() -> list[Rule]:
    return [
        required_not_null("payment_id"),
        required_not_null("booking_id"),
        valid_numeric("amount"),
        controlled_vocabulary("payment_status", PAYMENT_STATUS.spellings(), "STANDARDIZED_TO_FAILED"),
        standardization_required(["payment_status", "payment_method"]),
        refund_status_mismatch("refund_amount", "payment_status"),
    ]


def duplicate_event(df: DataFrame, key: str, message: str) -> DataFrame:
    """Findings for the second and later records of a key; records without a key never repeat."""
    keyed = df.select(record_key(key).alias("record_key"), key_scope(key).alias("_scope"), "row_number", "file_path")
    again = repeats(keyed, ["record_key", "_scope"], ["file_path", "row_number"])
    return again.select(
        "row_number",
        "record_key",
        "file_path",
        F.lit("WARN").alias("severity"),
        F.lit("duplicate_event").alias("rule_name"),
        F.lit(key).alias("column_name"),
        F.col("record_key").alias("bad_value"),
        F.lit(message).alias("error_message"),
        F.lit("CDC_KEEP_LATEST_IN_DBT").alias("action_taken"),
    )


def with_parent(child: DataFrame, parent: DataFrame, key: str, name: str = "has_parent") -> DataFrame:
    """Child rows with whether a parent of the same normalised key exists: one join where both sorts of rows are wanted."""
    known = parent.select(_token(key).alias("_parent")).distinct().withColumn("_known", F.lit(True))
    found = key_lookup(child.withColumn("_parent", _token(key)), known, "_parent", "left")
    return found.withColumn(name, F.col("_known").isNotNull()).drop("_parent", "_known")


def kept(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    return _lookup(child, parent, key, "left_semi")


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    return _lookup(child, parent, key, "left_anti")


def _lookup(child: DataFrame, parent: DataFrame, key: str, how: str) -> DataFrame:
    known = parent.select(_token(key).alias("_parent")).distinct()
    return key_lookup(child.withColumn("_parent", _token(key)), known, "_parent", how).drop("_parent")


def _token(key: str) -> Column:
    return F.coalesce(token_trim_first(key), F.lit(""))


def orphan_findings(orphaned: DataFrame) -> DataFrame:
    return orphaned.select(
        "row_number",
        record_key("payment_id").alias("record_key"),
        "file_path",
        F.lit("ERROR").alias("severity"),
        F.lit("relationship_missing").alias("rule_name"),
        F.lit("booking_id").alias("column_name"),
        F.coalesce("booking_id", F.lit("")).alias("bad_value"),
        F.lit(ORPHAN).alias("error_message"),
        F.lit("QUARANTINED").alias("action_taken"),
    )


class Validated:
    """One checked source. Each part is built when asked for, so a caller that wants the valid rows
    never pays for the log."""

    def __init__(
        self,
        source_name: str,
        source: DataFrame,
        rules: list[Rule],
        key: str,
        repeated: str,
        parents: DataFrame | None = None,
        parent_key: str = "booking_id",
    ):
        self.source_name, self.source, self.rules, self.key = source_name, source, rules, key
        self.repeated, self.parents, self.parent_key = repeated, parents, parent_key

    @cached_property
    def _sound(self) -> DataFrame:
        return valid_rows(self.source, self.rules)

    @cached_property
    def orphaned(self) -> DataFrame:
        return orphans(self._sound, self.parents, self.parent_key)

    @cached_property
    def valid(self) -> DataFrame:
        """Rows that break no ERROR rule and, where parents are given, refer to one of them."""
        return self._sound if self.parents is None else kept(self._sound, self.parents, self.parent_key)

    @cached_property
    def quarantine(self) -> DataFrame:
        rejected = quarantined_rows(self.source, self.rules, self.key)
        if self.parents is None:
            return rejected
        reason = {"reason": F.lit(ORPHAN), "record_key": record_key(self.key)}
        return rejected.unionByName(self.orphaned.withColumns(reason))

    @cached_property
    def errors(self) -> DataFrame:
        log = error_log(self.source, self.rules, self.key, self.source_name, F.col("file_path"))
        found = duplicate_event(self.source, self.key, self.repeated)
        if self.parents is not None:
            found = found.unionByName(orphan_findings(self.orphaned))
        return log.unionByName(log_rows(found, self.source_name))

    @cached_property
    def outcome(self) -> DataFrame:
        """Rows, valid, quarantined and logged rows and the profile of the source, in one row.

        Rules and profile are counted in one pass. Repeats are rows less distinct keys, and orphans are
        counted per parent key, so no row is shuffled whole.
        """
        hard = breaks_any(self.rules, "ERROR")
        profile = {"bookings": booking_profile, "payments": payment_profile}[self.source_name]()
        logged = sum((F.count_if(rule.broken) for rule in self.rules), F.lit(0))
        counts = self.source.agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count_if(hard).alias("rejected"),
            logged.alias("logged"),
            F.to_json(F.struct(*profile)).alias("quality_profile"),
        )
        keys = self.source.agg(
            (F.count(F.lit(1)) - F.count_distinct(F.struct(record_key(self.key), key_scope(self.key)))).alias("repeats")
        )
        counts = counts.withColumn("repeats", keys.scalar())
        lost = F.lit(0)
        if self.parents is not None:
            by_parent = self._sound.groupBy(_token(self.parent_key).alias("_parent")).agg(F.count(F.lit(1)).alias("n"))
            known = self.parents.select(_token(self.parent_key).alias("_parent")).distinct()
            lost = by_parent.join(known, "_parent", "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
        return counts.withColumn("orphans", lost).select(
            F.lit(self.source_name).alias("source_name"),
            (F.col("row_count") - F.col("rejected") - F.col("orphans")).alias("valid_rows"),
            (F.col("rejected") + F.col("orphans")).alias("quarantined_rows"),
            (F.col("logged") + F.col("repeats") + F.col("orphans")).alias("record_error_rows"),
            "quality_profile",
        )


def validate_bookings(bookings: DataFrame) -> Validated:
    """Bookings need ``row_number`` and ``file_path`` next to their text columns."""
    return Validated("bookings", bookings, booking_rules(), "booking_id", "Duplicate booking event")


def validate_payments(payments: DataFrame, valid_bookings: DataFrame | None = None) -> Validated:
    """With valid bookings, payments that refer to none of them move to quarantine.

    An orphan keeps the record number of its source file, so it can be traced back.
    """
    return Validated(
        "payments", payments, payment_rules(), "payment_id", "Duplicate payment event", valid_bookings
    )


def _duplicates(key: str) -> Column:
    """Rows with a key, less its distinct values."""
    filled = F.when(F.coalesce(F.col(key), F.lit("")) != "", F.upper(strip(key)))
    return F.count(filled) - F.count_distinct(filled)


def _count_dirty(*cols: str) -> Column:
    test = F.lit(False)
    for col in cols:
        test = test | dirty_token(col)
    return F.count_if(test)


def booking_profile() -> list[Column]:
    """Counts over bookings; out-of-order updates compare the two times as text."""
    late = (F.coalesce("updated_at", F.lit("")) != "") & (F.coalesce("created_at", F.lit("")) != "")
    return [
        _duplicates("booking_id").alias("duplicate_booking_id_rows"),
        _count_dirty(
            "booking_status", "payment_status", "booking_channel", "origin_airport", "destination_airport"
        ).alias("dirty_standardization_rows"),
        F.count_if(_below_zero("ticket_price")).alias("negative_ticket_rows"),
        F.count_if(is_blank("customer_id")).alias("missing_customer_rows"),
        F.count_if(late & (F.col("updated_at") < F.col("created_at"))).alias("out_of_order_update_rows"),
    ]


def payment_profile() -> list[Column]:
    plain_status = F.upper(F.coalesce("payment_status", F.lit("")))
    return [
        _duplicates("payment_id").alias("duplicate_payment_id_rows"),
        _count_dirty("payment_status", "payment_method", "currency").alias("dirty_standardization_rows"),
        F.count_if(_below_zero("amount")).alias("negative_amount_rows"),
        F.count_if(_above_zero("refund_amount") & ~plain_status.contains("REFUND")).alias(
            "refund_without_refund_status_rows"
        ),
    ]


def profile_bookings(src: DataFrame) -> DataFrame:
    return src.agg(*booking_profile())


def profile_payments(src: DataFrame) -> DataFrame:
    return src.agg(*payment_profile())


def quality_report(file_profiles: DataFrame, validated: list[Validated]) -> DataFrame:
    """One record per source file: profile, outcome counts and status.

    A source without record rules counts every row as valid.
    """
    outcomes = reduce(DataFrame.unionByName, [checked.outcome for checked in validated])
    return file_profiles.join(outcomes, "source_name", "left").withColumns(
        {
            "valid_rows": F.coalesce("valid_rows", "row_count"),
            "quarantined_rows": F.coalesce("quarantined_rows", F.lit(0)),
            "record_error_rows": F.coalesce("record_error_rows", F.lit(0)),
            "quality_profile": F.coalesce("quality_profile", F.lit("{}")),
        }
    )


def gate_failures(report: DataFrame) -> DataFrame:
    """Report records that stop a run: a required column is missing or there are no rows."""
    return report.where((F.size("missing_columns") > 0) | (F.col("row_count") == 0))


def schema_gate(report: DataFrame) -> None:
    """Raise when any source fails, naming at most the first hundred of them."""
    failed = gate_failures(report).select("source_name", "file_path", "missing_columns", "row_count").limit(100)
    rows = [row.asDict() for row in failed.collect()]
    if rows:
        raise ValueError(f"Validation failed: {rows}")
