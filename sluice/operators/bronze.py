"""Raw payloads: canonical form, change detection and the upsert as a snapshot rewrite."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.text import short_hash

KEY = ("source", "source_job_id")


def canonical(payload: Column) -> Column:
    """JSON with sorted keys and no white space; text that is no JSON stays as it is."""
    return F.coalesce(F.to_json(F.try_parse_json(payload)), payload)


def payload_hash(payload: Column) -> Column:
    return short_hash(canonical(payload))


def surrogate_id(*key: str) -> Column:
    """A positive id that depends on the key only, so it is stable without a counter."""
    return F.xxhash64(*key).bitwiseAND(F.lit((1 << 63) - 1))


def latest_in_batch(batch: DataFrame, key=KEY, order: str = "ordinal") -> DataFrame:
    """The last row of each key; of rows with one place in the order that with the largest hash. Columns that nobody
    reads afterwards are not shuffled."""
    rest = [c for c in batch.columns if c not in key]
    ordered = batch.withColumn("__at", F.struct(F.col(order).alias("o"), F.xxhash64(*rest).alias("h")))
    return ordered.groupBy(*key).agg(*(F.max_by(c, "__at").alias(c) for c in rest))


def diff(existing: DataFrame, batch: DataFrame, key=KEY) -> DataFrame:
    """Full outer join of two snapshots (key, payload, payload_hash), their columns as old_ and new_, with status new,
    changed, unchanged or absent. Flat columns let a reader of the status leave the payloads behind."""
    side = lambda frame, name: frame.select(*key, F.lit(True).alias(f"{name}"), *(F.col(c).alias(f"{name}_{c}") for c in frame.columns if c not in key))
    status = (
        F.when(F.col("new").isNull(), "absent")
        .when(F.col("old").isNull(), "new")
        .when(F.col("old_payload_hash") != F.col("new_payload_hash"), "changed")
        .otherwise("unchanged")
    )
    return side(existing, "old").join(side(batch, "new"), list(key), "full_outer").withColumn("status", status)


def upsert_raw(existing: DataFrame, batch: DataFrame, run_id: int, at: Column) -> DataFrame:
    """The next bronze snapshot: BRONZE's columns and status. First sight is kept, last sight is moved, the payload
    is replaced only where its hash differs."""
    latest = latest_in_batch(batch.withColumn("payload_hash", payload_hash(F.col("payload")))).select(*KEY, "payload", "payload_hash")
    seen, fresh = F.col("new").isNotNull(), F.col("status").isin("new", "changed")
    return diff(existing.drop("status"), latest).select(
        F.coalesce("old_raw_id", surrogate_id(*KEY)).alias("raw_id"),
        *KEY,
        F.when(fresh, F.col("new_payload")).otherwise(F.col("old_payload")).alias("payload"),
        F.when(fresh, F.col("new_payload_hash")).otherwise(F.col("old_payload_hash")).alias("payload_hash"),
        F.coalesce("old_first_seen_at", at).alias("first_seen_at"),
        F.when(seen, at).otherwise(F.col("old_last_seen_at")).alias("last_seen_at"),
        F.coalesce("old_first_run_id", F.lit(run_id).cast("long")).alias("first_run_id"),
        "status",
    )


def change_counts(upserted: DataFrame) -> DataFrame:
    """One row: new, changed, unchanged."""
    return upserted.agg(*(F.count_if(F.col("status") == s).alias(s) for s in ("new", "changed", "unchanged")))
