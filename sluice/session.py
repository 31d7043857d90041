"""SparkSession factory with the settings every plan here relies on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

#: UTC keeps date_trunc and timestamp parsing independent of the server's zone.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(app: str = "sluice", master: str | None = None, **conf: str) -> SparkSession:
    """The active session, or a new one. ``master`` is only for local runs; a cluster sets its own."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.sql.shuffle.partitions", os.environ.get("BENCH_CPUS", "8"))
        builder = builder.config("spark.driver.memory", os.environ.get("SLUICE_DRIVER_MEMORY", "8g"))
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str):
    """One driver table. Only Spark's reader touches the path, so any store works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
