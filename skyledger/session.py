"""Session settings and the shared work folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", **conf) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster use the one it gives you."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("skyledger")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared one that ``spark.checkpoint.dir`` names.

    Only a local master may do without the setting; the folder is then below the session's warehouse.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
