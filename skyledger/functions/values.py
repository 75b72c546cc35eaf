"""Numbers, booleans, dates, JSON and ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col, strip

# Text read as true, ISO dates with or without a time, and the number syntax of the validator.
TRUE_WORDS = ["true", "t", "1", "yes", "y"]
ISO_DATE = r"^\d{4}-\d{2}-\d{2}"
ISO_TIME = r"^\d{4}-\d{2}-\d{2}[T ]\d\S*$"
_DIGITS = r"\d+(_\d+)*"
NUMBER = rf"(?i)^[+-]?(inf|infinity|nan|({_DIGITS}\.?({_DIGITS})?|\.{_DIGITS})(e[+-]?{_DIGITS})?)$"


def abs_value(c: Column | str) -> Column:
    return F.abs(_col(c))


def floor_at(c: Column | str, other) -> Column:
    """The larger of the two; a NULL on either side is ignored."""
    return F.greatest(_col(c), other if isinstance(other, Column) else F.lit(other))


def bool_words(c: Column | str) -> Column:
    words = F.lower(F.trim(_col(c).cast("string"))).isin(TRUE_WORDS)
    return F.coalesce(words, F.lit(False))


_COMPARE = {
    "=": lambda a, b: a == b,
    ">=": lambda a, b: a >= b,
    ">": lambda a, b: a > b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
}


def flag(c: Column | str, op: str, value) -> Column:
    return _COMPARE[op](_col(c), F.lit(value))


def try_number(c: Column | str) -> Column:
    """Text as double, NULL when it is not a number; digit groups may be joined by underscores.

    Text with a letter or underscore that the cast reads differently takes the slower full check.
    """
    bare = strip(c)
    checked = F.when(bare.rlike(NUMBER), F.replace(bare, F.lit("_"), F.lit("")).try_cast("double"))
    return F.when(bare.rlike("[_xXdDfF]"), checked).otherwise(bare.try_cast("double"))


def is_number(c: Column | str) -> Column:
    return try_number(c).isNotNull()


def try_date(c: Column | str) -> Column:
    """Text as date, NULL unless the whole of it is an ISO date, or one with a time that can be read too."""
    value = _col(c)
    day = F.substring(value, 1, 10).try_cast("date")
    timed = value.rlike(ISO_TIME) & value.try_cast("timestamp").isNotNull()
    return F.when(value.rlike(ISO_DATE + "$") | timed, day)


def is_date(c: Column | str) -> Column:
    return try_date(c).isNotNull()


def date_trunc_cast(c: Column | str) -> Column:
    return F.to_date(_col(c))


def extract_hour(c: Column | str) -> Column:
    return F.hour(_col(c))


def calendar(c: Column | str) -> list[Column]:
    """Year, month, day, day of week (Sunday is 0) and quarter."""
    day = _col(c)
    return [
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        (F.dayofweek(day) - 1).alias("day_of_week"),
        F.quarter(day).alias("quarter"),
    ]


def iso_z(c: Column | str) -> Column:
    """ISO timestamp, with or without offset, as the instant; NULL when it cannot be read."""
    value = _col(c)
    return F.when(value.rlike(ISO_DATE), value.try_cast("timestamp"))


def json_text(c: Column | str, path: str) -> Column:
    return F.get_json_object(_col(c), path)


def json_is_object(c: Column | str) -> Column:
    """True when the text is one JSON object."""
    return F.coalesce(F.schema_of_variant(F.try_parse_json(_col(c))).startswith("OBJECT"), F.lit(False))


def row_json(*cols: Column | str) -> Column:
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def ratio(num: Column, den: Column) -> Column:
    return num.cast("double") / F.nullif(den, F.lit(0))


def now() -> Column:
    return F.current_timestamp()
