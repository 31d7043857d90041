"""Data-quality checks and the gate: one aggregate pass for all row checks, failing counts unpivoted to rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NOT_SKILLED = ("other", "it_support", "engineering_manager")


@dataclass(frozen=True)
class Check:
    name: str
    severity: str  # error blocks publishing, warn is recorded
    details: str
    threshold: int = 0


CHECKS = (
    Check("title_not_empty", "error", "Titles are there"),
    Check("salary_min_le_max", "error", "Ranges aren't inverted"),
    Check("salary_usd_plausible", "warn", "A year's salary is 2,000 to 1,000,000 USD"),
    Check("posted_at_not_future", "error", "No posting is dated ahead"),
    Check("posted_within_year", "warn", "Postings are of the last year"),
    Check("tech_description_present", "warn", "Tech postings have a description"),
    Check("source_fresh", "error", "Each source has a posting of the last 14 days"),
    Check("duplicate_rate_under_30pct", "warn", "At most 30 % are duplicates"),
    Check("extracted_skills_nonempty", "warn", "Technical roles have a skill"),
)


def row_checks(as_of: Column) -> dict[str, Column]:
    """Predicates of failing rows of silver."""
    usd = F.col("salary_usd_year_min")
    return {
        "title_not_empty": F.trim("title") == "",
        "salary_min_le_max": F.col("salary_max").isNotNull() & (F.col("salary_min") > F.col("salary_max")),
        "salary_usd_plausible": (usd < 2000) | (usd > 1_000_000),
        "posted_at_not_future": F.col("posted_at") > as_of + F.expr("INTERVAL 1 DAY"),
        "posted_within_year": F.col("posted_at") < as_of - F.expr("INTERVAL 365 DAYS"),
        "tech_description_present": F.col("is_tech") & (F.char_length(F.coalesce("description", F.lit(""))) < 100),
    }


def failing_counts(silver: DataFrame, extractions: DataFrame, as_of: Column) -> DataFrame:
    """(check_name, failing_rows), a row for each check."""
    counts = [F.count_if(p).alias(n) for n, p in row_checks(as_of).items()]
    crowded = F.coalesce((F.avg(F.col("is_duplicate").cast("int")) > 0.30).cast("long"), F.lit(0)).alias("duplicate_rate_under_30pct")
    names = [*row_checks(as_of), "duplicate_rate_under_30pct"]
    wide = silver.agg(*counts, crowded)
    rows = wide.unpivot([], names, "check_name", "failing_rows").select("check_name", F.col("failing_rows").cast("long"))
    stale = silver.groupBy("source").agg(F.max("posted_at").alias("last")).where(F.col("last") < as_of - F.expr("INTERVAL 14 DAYS"))
    bare = extractions.join(silver.select("job_id", "content_hash"), ["job_id", "content_hash"]).where((F.size("skills") == 0) & ~F.col("role_family").isin(*NOT_SKILLED))
    single = lambda frame, name: frame.agg(F.count("*").alias("failing_rows")).select(F.lit(name).alias("check_name"), "failing_rows")
    return rows.union(single(stale, "source_fresh")).union(single(bare, "extracted_skills_nonempty"))


def run_checks(silver: DataFrame, extractions: DataFrame, run_id: int, as_of: Column, checks=CHECKS) -> DataFrame:
    """Ledger rows of a run: schema.DQ."""
    table = silver.sparkSession.createDataFrame([(c.name, c.severity, c.details, c.threshold) for c in checks], "check_name string, severity string, details string, threshold int")
    counted = failing_counts(silver, extractions, as_of).join(F.broadcast(table), "check_name")  # nine rows
    return counted.select(F.lit(run_id).cast("long").alias("run_id"), "check_name", "severity", (F.col("failing_rows") <= F.col("threshold")).alias("passed"), "failing_rows", "details", as_of.alias("checked_at"))


def blocking(results: DataFrame) -> list[str]:
    """Names of failed checks that block publishing (a row for each check at most)."""
    return [r["check_name"] for r in results.where("severity = 'error' and not passed").orderBy("check_name").collect()]


def record(ledger: DataFrame, results: DataFrame) -> DataFrame:
    """The next ledger: a later result of (run, check) replaces outcome and time, not severity or details."""
    both = ledger.withColumn("gen", F.lit(0)).unionByName(results.withColumn("gen", F.lit(1)))
    late, early = F.struct("passed", "failing_rows", "checked_at"), F.struct("severity", "details")
    merged = both.groupBy("run_id", "check_name").agg(F.max_by(late, "gen").alias("l"), F.min_by(early, "gen").alias("e"))
    return merged.select("run_id", "check_name", "e.severity", "l.passed", "l.failing_rows", "e.details", "l.checked_at")
