"""Upserts, slice replacement and partition replacement as plans; ``sources.versions`` has them for written tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import like_any
from .dedupe import keep_first
from .filters import rows_in


def upsert(
    target: DataFrame, new: DataFrame, keys: list[str], update_cols: list[str], order: list[Column] | None = None
) -> DataFrame:
    """Insert new keys; for known keys take only ``update_cols`` from the new row.

    Both sides are unique by key, so no join can fan out or pile up on one key. The new rows, and the keys of
    theirs that are known, are the right sides of joins: where they are few, AQE broadcasts them and the target is not
    shuffled. With ``order`` the new rows are first reduced to the first one per key. On a written table
    ``versions.Transaction.merge`` does this with the buckets that the new rows touch.
    """
    if order:
        new = keep_first(new, keys, order)
    fresh = new.select(*keys, F.struct(*[name for name in target.columns]).alias("_new"))

    def value(name: str) -> Column:
        if name in update_cols and name not in keys:
            return F.when(F.col("_new").isNotNull(), F.col("_new")[name]).otherwise(F.col(name)).alias(name)
        return F.col(name)

    known = target.join(fresh, keys, "left").select(*[value(name) for name in target.columns])
    hit = target.select(*keys).join(new.select(*keys), keys, "left_semi")
    return known.unionByName(new.join(hit, keys, "left_anti").select(*target.columns))


def insert_missing(target: DataFrame, new: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """Rows of ``new`` whose key the target lacks, one per key: append them to the target."""
    once = keep_first(new, keys, order) if order else new.dropDuplicates(keys)
    return once.join(target.select(*keys), keys, "left_anti")


def replace_slice(target: DataFrame, new: DataFrame, slice_col: str, patterns: list[str] | None = None) -> DataFrame:
    """Drop the earlier slice of the same source, then add the new rows.

    The slice is every path like one of the patterns, or the very paths the new rows carry.
    """
    if patterns:
        kept = target.where(~F.coalesce(like_any(slice_col, patterns), F.lit(False)))
    else:
        kept = rows_in(target, new, slice_col, anti=True)
    return kept.unionByName(new.select(*target.columns))


def delete_insert(target: DataFrame, new: DataFrame, part_col: str, keys: list[str]) -> DataFrame:
    """Drop the partitions that the new rows touch and every row with a new key, then add the new rows.

    Both the target and the new rows are unique by key, so the key join cannot pile up.
    """
    kept = rows_in(target, new, part_col, anti=True)
    if keys != [part_col]:
        kept = kept.join(new.select(*keys).distinct(), keys, "left_anti")
    return kept.select(*target.columns).unionByName(new.select(*target.columns))
