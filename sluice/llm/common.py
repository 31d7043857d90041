"""What several operators share: word patterns, shared folders, checked broadcasts, running sums."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space that parts words, as Java and RE2 patterns write it.
SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What a broadcast may hold.
MOST_ROWS, MOST_BYTES = 200_000, 32 << 20
#: Texts that are sent to Python at a time.
TEXTS = 1000
#: Setting by which a finished execution's shuffle files go at once.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_C = ctypes.CDLL(None)


# ---------------------------------------------------------------- shared folders
def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Where that is unset, a checkpoint folder that the
    context has; and on a single machine (master local), as in tests, a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        context = spark.sparkContext
        if context._jsc.sc().getCheckpointDir().isEmpty():
            if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            context.setCheckpointDir(tempfile.mkdtemp(prefix="sluice-checkpoint-"))
        found = context._jsc.sc().getCheckpointDir().get()
    return found.rstrip("/")


_runs: dict[tuple[str, str], str] = {}
_within: ContextVar[str] = ContextVar("within", default="")


def _hadoop(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def run_dir(spark: SparkSession) -> str:
    """This application's own folder in the shared one; it goes when the driver ends."""
    key = (spark.sparkContext.applicationId, shared_dir(spark))
    if key not in _runs:
        _runs[key] = f"{key[1]}/sluice-{uuid.uuid4().hex}"
        system, path = _hadoop(spark, _runs[key])
        system.mkdirs(path)
        system.deleteOnExit(path)
    return _runs[key]


@contextmanager
def workspace(spark: SparkSession, name: str) -> Iterator[None]:
    """Scratch tables made inside go to a folder that is emptied first, for steps whose results are written before the
    next step with this name begins."""
    system, path = _hadoop(spark, f"{run_dir(spark)}/{name}")
    system.delete(path, True)
    token = _within.set(f"/{name}")
    try:
        yield
    finally:
        _within.reset(token)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{run_dir(spark)}{_within.get()}/{name}-{uuid.uuid4().hex}"


@contextmanager
def freeing(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is executed inside go when it is done, and not when the driver happens to collect garbage."""
    before = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREED) if before is None else spark.conf.set(FREED, before)


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame, written to the shared folder and read back: its lineage is cut, it is made once, and the shuffle files
    that it was made from are no longer needed."""
    spark = frame.sparkSession
    path = scratch(spark, name)
    with freeing(spark):
        frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


# ---------------------------------------------------------------- broadcasts
def width(field: T.StructField) -> Column:
    """About how many bytes a column's value takes."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0))
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0))
    return F.lit(8)


def small(frame: DataFrame, rows: int = MOST_ROWS, size: int = MOST_BYTES) -> DataFrame:
    """The frame with a broadcast hint if it is found to have at most so many rows and bytes, else as it is: Spark then
    joins by shuffle, and splits skewed partitions. For narrow, stored frames."""
    total = sum((width(f) for f in frame.schema.fields), F.lit(16))
    n, held = frame.agg(F.count(F.lit(1)), F.coalesce(F.sum(total), F.lit(0))).first()
    return F.broadcast(frame) if n <= rows and held <= size else frame


# ---------------------------------------------------------------- running sums
def running(frame: DataFrame, order: list[Column], **sums: str) -> DataFrame:
    """``frame`` with rank (from 1, in a total ``order``) and, for each named column of ``sums``, the sum over the rows
    before. Rows are dealt out by ranges of the order; only a row a range goes to the driver."""
    spark = frame.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = stored(frame.repartitionByRange(parts, *order).withColumn("__part", F.spark_partition_id()), "ranged")
    totals = ranged.groupBy("__part").agg(F.count("*").alias("n"), *(F.sum(c).alias(k) for k, c in sums.items()))
    before, offsets = [0] * (1 + len(sums)), []
    for row in sorted(map(tuple, totals.collect())):  # a row a range
        offsets.append((row[0], *before))
        before = [a + (b or 0) for a, b in zip(before, row[1:], strict=True)]
    names = ["__rank", *(f"__{k}" for k in sums)]
    kinds = ["long", *(totals.schema[k].dataType.simpleString() for k in sums)]
    starts = spark.createDataFrame(offsets, ", ".join(f"{k} {t}" for k, t in zip(["__part", *names], ["int", *kinds], strict=True)))
    own = W.partitionBy("__part").orderBy(*order)
    earlier = own.rowsBetween(W.unboundedPreceding, -1)
    made = {"rank": F.row_number().over(own) + F.col("__rank")}
    made |= {k: F.coalesce(F.sum(c).over(earlier), F.lit(0)) + F.col(f"__{k}") for k, c in sums.items()}
    return ranged.join(F.broadcast(starts), "__part").withColumns(made).drop("__part", *names)


# ---------------------------------------------------------------- Python tasks
def few_rows(spark: SparkSession) -> None:
    """Has Spark send texts to Python by at most ``TEXTS`` at a time, from now on in this session: 10,000 long texts make
    buffers of tens of megabytes on both sides. A smaller setting stays."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(setting)) <= TEXTS:
        spark.conf.set(setting, TEXTS)


def release() -> None:
    """Gives memory that is free, but held by the allocators, back to the system."""
    pa.default_memory_pool().release_unused()
    if hasattr(_C, "malloc_trim"):
        _C.malloc_trim(0)


def lean(task):
    """A generator of a task that releases memory at its end: Python workers live on, from one stage to the next."""

    @wraps(task)
    def run(*args):
        try:
            yield from task(*args)
        finally:
            release()

    return run


def slices(batches, rows: int = 1024):
    """The batches in slices, so that few rows at a time are Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


# ---------------------------------------------------------------- words
def lower_ascii(column):
    """A-Z lower-cased, nothing else."""
    return F.translate(column, UPPER, LOWER)


def words_of(text):
    """Array of the words of a text; null gives an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")
