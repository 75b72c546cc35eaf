"""Landing files under keys, and result tables by layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import work_folder


def land(df: DataFrame, root: str, parts: list[str]) -> None:
    """Land raw rows as delimited files below ``key=value`` folders; a rerun replaces its own keys only.

    Rows are gathered by key for the write, and AQE splits a key that is too large for one task.
    """
    from .files import write_csv

    write_csv(df.hint("rebalance", *parts), root, parts)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows in a work folder of their own; a plan over them is short and knows their size."""
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_table(
    df: DataFrame,
    root: str,
    layer: str,
    name: str,
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
    label: str | None = None,
) -> int:
    """Publish a result table as the next version of the warehouse; with partitions, overwrite replaces only those it holds.

    A version is visible as a whole or not at all, and what is being read stays (``versions``). A second call with
    the same ``label`` changes nothing. Returns the version.
    """
    from .versions import Warehouse

    house = Warehouse(df.sparkSession, root)
    if label is not None and house.holds(label):
        return house.manifest()[1]["labels"][label]
    change, table = house.begin(), f"{layer}/{name}"
    if mode == "append" and change.table(table) is not None:
        change.append(table, df)
    elif partition_by and len(partition_by) == 1 and change.table(table) is not None:
        change.replace_parts(table, df, partition_by[0])
    else:
        change.replace(table, df, partition_by)
    return change.commit(label)


def read_table(spark: SparkSession, root: str, layer: str, name: str) -> DataFrame:
    """The latest version of a result table."""
    from .versions import Warehouse

    return Warehouse(spark, root).read(f"{layer}/{name}")
