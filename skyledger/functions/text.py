"""Text normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a file validator strips from both ends of a field.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Strip every kind of whitespace; SQL ``trim`` takes spaces only."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def is_blank(c: Column | str) -> Column:
    return strip(F.coalesce(_col(c), F.lit(""))) == ""


def trim_upper(c: Column | str) -> Column:
    return F.trim(F.upper(_col(c)))


def trim_lower(c: Column | str) -> Column:
    return F.trim(F.lower(_col(c)))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(F.trim(_col(c)), F.lit(""))


def default(c: Column | str, value) -> Column:
    return F.coalesce(_col(c), F.lit(value))


def first_present(preferred: Column | str, *others: Column | str) -> Column:
    """The preferred code unless it is empty, else the first other one that is not NULL."""
    return F.coalesce(F.nullif(_col(preferred), F.lit("")), *[_col(c) for c in others])


def token_replace_first(c: Column | str) -> Column:
    """Spaces become underscores *before* trimming, so padding survives as underscores."""
    return F.trim(F.upper(F.replace(_col(c), F.lit(" "), F.lit("_"))))


def token_trim_first(c: Column | str) -> Column:
    """Whitespace is stripped before inner spaces become underscores."""
    return F.replace(F.upper(strip(_col(c))), F.lit(" "), F.lit("_"))


# Fixed value: a terminal suffix on an airport code.
TERMINAL = "-T[0-9]+$"


def strip_terminal(c: Column | str) -> Column:
    return F.regexp_replace(trim_upper(c), TERMINAL, "")


def strip_terminal_feature(c: Column | str) -> Column:
    """The suffix goes before trim and upper, so padded or lower-case input keeps it."""
    return F.upper(F.trim(F.regexp_replace(_col(c), TERMINAL, "")))


def dirty_token(c: Column | str) -> Column:
    """True when a token is padded, holds an inner space or is not upper case; NULL is clean."""
    value, bare = _col(c), strip(c)
    drift = (value != bare) | bare.contains(" ") | (bare != F.upper(bare))
    return F.coalesce(drift, F.lit(False))


def like_any(c: Column | str, patterns: list[str]) -> Column:
    """SQL LIKE against any of the patterns."""
    test = _col(c).like(patterns[0])
    for pattern in patterns[1:]:
        test = test | _col(c).like(pattern)
    return test


def clip(c: Column | str, length: int = 2000) -> Column:
    return F.substring(_col(c), 1, length)
