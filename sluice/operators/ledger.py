"""The run ledger: appended events, folded to one row a run."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice import schema


def event(spark: SparkSession, run_id: int, status: str, stats: dict | None = None, error: str | None = None) -> DataFrame:
    """One row to append: a start (running) or an end (success, failed, blocked)."""
    text = json.dumps(stats or {}, sort_keys=True, default=str)
    row = spark.createDataFrame([(run_id, status, text, error)], "run_id long, status string, stats string, error string")
    now, running = F.current_timestamp(), F.col("status") == "running"
    row = row.withColumns({"started_at": F.when(running, now), "finished_at": F.when(~running, now)})
    return row.select(*(c.split()[0] for c in schema.RUNS.split(", ")))


def fold(events: DataFrame) -> DataFrame:
    """schema.RUNS: the last state of each run."""
    last = F.max_by(F.struct("status", "stats", "error"), F.coalesce("finished_at", "started_at"))
    rows = events.groupBy("run_id").agg(F.min("started_at").alias("started_at"), F.max("finished_at").alias("finished_at"), last.alias("l"))
    return rows.select("run_id", "started_at", "finished_at", "l.status", "l.stats", "l.error")


def next_run_id(runs: DataFrame) -> int:
    return (runs.agg(F.max("run_id")).first()[0] or 0) + 1


def last_run(runs: DataFrame) -> DataFrame:
    return runs.orderBy(F.desc("run_id")).limit(1)


def recent_runs(runs: DataFrame, n: int = 10) -> DataFrame:
    """The last runs with their durations."""
    return runs.orderBy(F.desc("run_id")).limit(n).withColumn("duration", F.col("finished_at") - F.col("started_at"))


def latest_checks(results: DataFrame) -> DataFrame:
    """Results of the last run, failures first."""
    last = results.agg(F.max("run_id").alias("run_id"))
    return results.join(F.broadcast(last), "run_id").orderBy("passed", "severity", "check_name")  # one row
