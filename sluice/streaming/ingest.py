"""Streaming ingestion (an addition to the batch run): landed raw rows are upserted batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice import schema
from sluice.operators import bronze
from sluice.pipeline import Store

RAW = "source string, source_job_id string, payload string, ordinal long"


def upsert_stream(spark: SparkSession, landed: str, root: str, checkpoint: str):
    """Reads Parquet files of raw rows as they land and keeps the bronze snapshot current; returns the query. A batch
    that is replayed after a failure finds its rows unchanged, so the upsert is idempotent."""

    def apply(batch: DataFrame, number: int) -> None:
        store = Store(spark, root)
        # Run ids of batch runs are positive.
        upserted = bronze.upsert_raw(store.read("bronze", schema.BRONZE), batch, -1 - number, F.current_timestamp())
        store.write("bronze", upserted, schema.BRONZE)

    rows = spark.readStream.schema(RAW).parquet(landed)
    return rows.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def weekly_counts(spark: SparkSession, landed: str, ddl: str, moment: str = "ts", late: str = "7 days") -> DataFrame:
    """Streaming count by week and kind with a watermark."""
    rows = spark.readStream.schema(ddl).parquet(landed)
    return rows.withWatermark(moment, late).groupBy(F.window(moment, "1 week", startTime="4 days").alias("week"), "event_type").agg(F.count("*").alias("n"))
