"""The table of registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .fixtures import Tables, present
from .oracle import oracle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None, **parts: str):
    """Register ``build(tables)`` under a name, with its oracle when SQL can state it."""

    def add(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return present(build(Tables(spark, sf_dir)))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = oracle(sql, **parts)
        return build

    return add
