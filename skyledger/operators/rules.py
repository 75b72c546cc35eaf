"""Declarative record rules.

A row rule is a predicate on one record, so any number of them is evaluated in one pass with no
shuffle. Rules about sets of records (repeats, missing parents) shuffle only a key and the record
number and are added to the log afterwards.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dirty_token, is_blank, is_date, is_number, md5_id, token_trim_first, try_number

ERROR, WARN = "ERROR", "WARN"

LOG_COLUMNS = [
    "error_id", "source_name", "file_path", "row_number", "record_key",
    "severity", "rule_name", "column_name", "bad_value", "error_message", "action_taken", "place",
]
SET_RULE = 100  # place of findings about sets of records, after every row rule


@dataclass(frozen=True)
class Rule:
    """``broken`` must be true or false, never NULL."""

    severity: str
    name: str
    column: str
    broken: Column
    bad_value: Column
    message: str
    action: str

    def finding(self, place: int) -> Column:
        """The finding, with the place of its rule: an error id leaves the column out, so two findings of
        one record can share it, and the one of the earlier rule is stored."""
        return F.struct(
            F.lit(self.severity).alias("severity"),
            F.lit(self.name).alias("rule_name"),
            F.lit(self.column).alias("column_name"),
            F.coalesce(self.bad_value, F.lit("")).alias("bad_value"),
            F.lit(self.message).alias("error_message"),
            F.lit(self.action).alias("action_taken"),
            F.lit(place).alias("place"),
        )


def _both(columns: list[str]) -> str:
    return "|".join(columns)


def required_not_null(col: str) -> Rule:
    return Rule(ERROR, "required_not_null", col, is_blank(col), F.col(col), f"Missing {col}", "QUARANTINED")


def valid_date(col: str) -> Rule:
    return Rule(ERROR, "valid_date", col, ~is_date(col), F.col(col), f"Invalid {col}", "QUARANTINED")


def valid_numeric(col: str) -> Rule:
    return Rule(ERROR, "valid_numeric", col, ~is_number(col), F.col(col), f"Invalid {col}", "QUARANTINED")


def controlled_vocabulary(col: str, terms: list[str], action: str) -> Rule:
    token = F.coalesce(token_trim_first(col), F.lit(""))
    message = f"Unknown {col.replace('_', ' ')}"
    unknown = (token != "") & ~token.isin(terms)
    return Rule(WARN, "controlled_vocabulary", col, unknown, F.col(col), message, action)


def standardization_required(cols: list[str]) -> Rule:
    drift = F.lit(False)
    for col in cols:
        drift = drift | dirty_token(col)
    return Rule(
        WARN, "standardization_required", _both(cols), drift, F.lit(""),
        "Casing/spacing drift detected", "STANDARDIZED_IN_DBT",
    )


def negative_value(col: str, message: str) -> Rule:
    negative = F.coalesce(_below_zero(col), F.lit(False))
    return Rule(WARN, "negative_value", col, negative, F.col(col), message, "ABS_CORRECTION_IN_DBT")


def missing_optional(col: str, action: str) -> Rule:
    return Rule(WARN, "missing_optional", col, is_blank(col), F.lit(""), f"Missing optional {col}", action)


def refund_status_mismatch(amount: str, status: str) -> Rule:
    token = F.coalesce(token_trim_first(status), F.lit(""))
    mismatch = F.coalesce(_above_zero(amount), F.lit(False)) & ~token.contains("REFUND")
    return Rule(
        WARN, "refund_status_mismatch", _both([amount, status]), mismatch, F.col(status),
        "Refund amount without refund status", "FLAGGED_FOR_RECONCILIATION",
    )


def _number(col: str) -> Column:
    """Number to compare with zero; not-a-number compares as false on both sides."""
    value = try_number(col)
    return F.when(~F.isnan(value), value)


def _below_zero(col: str) -> Column:
    return _number(col) < 0


def _above_zero(col: str) -> Column:
    return _number(col) > 0


def record_key(col: str, row_number: str = "row_number") -> Column:
    """Normalised key of a record, or ``row-N`` when it has none."""
    token = F.nullif(token_trim_first(col), F.lit(""))
    return F.coalesce(token, F.concat(F.lit("row-"), F.col(row_number).cast("string")))


def key_scope(col: str) -> Column:
    """Where a record key tells records apart: everywhere, or in its file if it is the number of a record."""
    named = F.nullif(token_trim_first(col), F.lit("")).isNotNull()
    return F.when(named, F.lit("")).otherwise(F.coalesce("file_path", F.lit("")))


def breaks_any(rules: list[Rule], severity: str | None = None) -> Column:
    test = F.lit(False)
    for rule in rules:
        if severity in (None, rule.severity):
            test = test | rule.broken
    return test


def apply_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add ``errors``, the findings of every broken rule in rule order."""
    found = F.array_compact(F.array(*[F.when(r.broken, r.finding(n)) for n, r in enumerate(rules)]))
    return df.withColumn("errors", found)


def valid_rows(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows that break no ERROR rule."""
    return df.where(~breaks_any(rules, ERROR))


def quarantined_rows(df: DataFrame, rules: list[Rule], key: str) -> DataFrame:
    """Rows that break an ERROR rule, with their key and every reason."""
    hard = [rule for rule in rules if rule.severity == ERROR]
    reasons = F.concat_ws("; ", *[F.when(rule.broken, F.lit(rule.message)) for rule in hard])
    return (
        df.where(breaks_any(hard))
        .withColumn("reason", reasons)
        .withColumn("record_key", record_key(key))
    )


def split(df: DataFrame, rules: list[Rule], key: str) -> tuple[DataFrame, DataFrame]:
    return valid_rows(df, rules), quarantined_rows(df, rules, key)


def error_log(df: DataFrame, rules: list[Rule], key: str, source_name: str, file_path: Column) -> DataFrame:
    """One row per broken rule; every rule is evaluated once per row and a clean row yields nothing."""
    keyed = df.withColumn("record_key", record_key(key))
    exploded = apply_rules(keyed, rules).select(
        "row_number", "record_key", file_path.alias("file_path"), F.inline("errors")
    )
    return log_rows(exploded, source_name)


def log_rows(findings: DataFrame, source_name: str) -> DataFrame:
    """Give findings their source and stable id."""
    named = findings.withColumn("source_name", F.lit(source_name))
    error_id = md5_id("source_name", "file_path", "row_number", "rule_name", "record_key", "bad_value")
    if "place" not in findings.columns:
        named = named.withColumn("place", F.lit(SET_RULE))
    return named.withColumn("error_id", error_id).select(*LOG_COLUMNS)
