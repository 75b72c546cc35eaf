"""Row filters and key lookups that hold up when one key owns a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import blank_to_null


def drop_blank_key(df: DataFrame, col: str) -> DataFrame:
    return df.where(blank_to_null(col).isNotNull())


def flown_flights(df: DataFrame, n: int | None = None, order_by: list[str] | None = None) -> DataFrame:
    """Complete flights that were neither cancelled nor diverted; with ``n`` the first of them in the given order."""
    present = F.lit(True)
    for name in ("FlightDate", "Reporting_Airline", "Origin", "Dest"):
        present = present & (F.coalesce(F.col(name), F.lit("")) != "")
    flown = df.where(present)
    for name in ("Cancelled", "Diverted"):
        flown = flown.where(F.coalesce(F.col(name).try_cast("double"), F.lit(0.0)) == 0)
    if n is None:
        return flown
    if not order_by:
        raise ValueError("the first flights need an order")
    return flown.orderBy(*order_by).limit(n)


def latest_run(df: DataFrame, run_col: str, time_col: str) -> DataFrame:
    """Rows of the run that wrote last; equal times go to the larger run id."""
    newest = df.agg(F.max(F.struct(time_col, run_col))[run_col].alias(run_col)).scalar()
    return df.where(F.col(run_col) == newest)


def rows_in(df: DataFrame, keys: DataFrame, col: str, anti: bool = False) -> DataFrame:
    """Rows whose value is (or is not) among the keys."""
    return key_lookup(df, keys.select(col).distinct(), col, "left_anti" if anti else "left_semi").select(*df.columns)


def key_lookup(df: DataFrame, keys: DataFrame, key: str, how: str) -> DataFrame:
    """Semi, anti or left join of rows to distinct keys.

    One plan for every size: AQE broadcasts keys that prove small, and splits the rows of a hot key over tasks.
    """
    return df.join(keys, key, how)


def not_null_all(df: DataFrame, *cols: str) -> DataFrame:
    return df.dropna(subset=list(cols))


def where_like_any(df: DataFrame, col: Column | str, patterns: list[str]) -> DataFrame:
    from ..functions import like_any

    return df.where(like_any(col, patterns))
