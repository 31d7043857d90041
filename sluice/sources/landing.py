"""Landed JSON payloads as raw rows (source, source_job_id, payload), and the other readers and writers.

Fetching over HTTP is left to whatever lands the files; a reader takes a path that Spark can open.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RAW = "source string, source_job_id string, payload string, ordinal long"


class MalformedFile(ValueError):
    """A landed file is no JSON array, nor an object that holds one."""


class MissingKey(ValueError):
    """An item has no key."""


def _items(spark: SparkSession, path: str, under: str, source: str, key: str) -> DataFrame:
    """RAW of the files at ``path``, each a page: a JSON array, or an object with one ``under`` a key. Files go in the
    order of their names, so the last of a key is that of the last page. A malformed file is one row without payload."""
    landed = spark.read.text(path, wholetext=True)
    named = lambda path: F.regexp_replace(path, "^file:/+", "file:/").alias("file")
    pages = spark.createDataFrame(list(enumerate(sorted(landed.inputFiles()), 1)), "page long, path string")  # what the scan has listed
    files = landed.select(named(F.col("_metadata.file_path")), "value").join(F.broadcast(pages.select("page", named(F.col("path")))), "file")
    body = F.when(F.ltrim("value").startswith("["), F.col("value")).otherwise(F.get_json_object("value", f"$.{under}"))
    body = F.when(F.json_array_length(body).isNotNull(), body)
    listed = F.coalesce(F.from_json(body, "array<string>"), F.array(F.lit(None).cast("string")))
    rows = files.select("page", F.posexplode(listed).alias("pos", "payload"))
    ordinal = F.col("page") * F.lit(1 << 32) + F.col("pos")
    return rows.select(F.lit(source).alias("source"), F.get_json_object("payload", f"$.{key}").alias("source_job_id"), "payload", ordinal.alias("ordinal"))


def read_remotive(spark: SparkSession, path: str) -> DataFrame:
    return _items(spark, path, "jobs", "remotive", "id")


def read_arbeitnow(spark: SparkSession, path: str) -> DataFrame:
    return _items(spark, path, "data", "arbeitnow", "slug")


def read_remoteok(spark: SparkSession, path: str) -> DataFrame:
    """Items without id (the legal notice) go."""
    return _items(spark, path, "jobs", "remoteok", "id").where("payload is null or source_job_id is not null")


def read_adzuna(spark: SparkSession, path: str) -> DataFrame:
    return _items(spark, path, "results", "adzuna_in", "id")


READERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "remotive": read_remotive,
    "arbeitnow": read_arbeitnow,
    "remoteok": read_remoteok,
    "adzuna_in": read_adzuna,
}


def read_sources(spark: SparkSession, paths: dict[str, str | None], readers=None, staging: str | None = None) -> tuple[DataFrame, dict[str, str]]:
    """All sources that can be read, and what became of each: ok, skipped (no path) or failed (with the reason).

    Each source is read through before it counts as ok, so a failure in a task, a malformed file or an item without
    key is its own and the others go on. With ``staging`` (a folder) its rows are written there and read once."""
    readers, frames, status = readers or READERS, [], {}
    for name, path in paths.items():
        if path is None:
            status[name] = "skipped"
            continue
        try:
            rows = readers[name](spark, path)
            if staging is not None:
                rows.write.mode("overwrite").parquet(f"{staging}/{name}")
                rows = spark.read.schema(RAW).parquet(f"{staging}/{name}")
            files, items = rows.agg(F.count_if(F.col("payload").isNull()), F.count_if(F.col("payload").isNotNull() & F.col("source_job_id").isNull())).first()
            if files:
                raise MalformedFile(f"{files} files")
            if items:
                raise MissingKey(f"{items} items")
            frames.append(rows)
            status[name] = "ok"
        except Exception as error:  # one source's failure is recorded, the others go on
            status[name] = f"failed: {type(error).__name__}"
    out = spark.createDataFrame([], RAW)
    for frame in frames:
        out = out.unionByName(frame)
    return out, status


LABELS = "id string, title string, company string, location string, text string, labelled boolean, skills array<string>, role_family string, seniority string"


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of evaluation records; blank lines are skipped."""
    return spark.read.schema(LABELS).json(path)


def write_labels(labels: DataFrame, path: str) -> None:
    labels.write.mode("overwrite").json(path)


def read_resume(spark: SparkSession, path: str) -> DataFrame:
    """(text): one text file."""
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "text")
