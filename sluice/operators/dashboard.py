"""The questions a dashboard asks of the published tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def kpis(jobs: DataFrame) -> DataFrame:
    return jobs.agg(F.count("*").alias("jobs"), F.count_if("llm_enriched").alias("enriched"), F.count_if(F.col("salary_usd_year_min").isNotNull()).alias("with_salary"), F.count_distinct("source").alias("sources"))


def role_mix(jobs: DataFrame, known_only: bool = False) -> DataFrame:
    counted = jobs.groupBy("role_family").agg(F.count("*").alias("jobs")).orderBy(F.desc("jobs"), "role_family")
    return counted.where("role_family <> 'unknown'") if known_only else counted


def filtered(jobs: DataFrame, enriched_only: bool = False, role: str | None = None) -> DataFrame:
    jobs = jobs.where("llm_enriched") if enriched_only else jobs
    return jobs.where(F.col("role_family") == role) if role else jobs


def top_skills(jobs: DataFrame, n: int = 20, **filters) -> DataFrame:
    """The n most frequent skills with their share of all rows that pass the filters."""
    jobs = filtered(jobs, **filters)
    total = jobs.agg(F.count("*").alias("total"))
    top = jobs.select(F.explode("skills").alias("skill")).groupBy("skill").agg(F.count("*").alias("jobs")).orderBy(F.desc("jobs"), "skill").limit(n)
    return top.join(F.broadcast(total)).select("skill", "jobs", F.round(100.0 * F.col("jobs") / F.col("total"), 1).cast("double").alias("pct")).orderBy(F.desc("jobs"), "skill")  # one row


def median_salary(jobs: DataFrame, group: str = "role_family", skip=("unknown",)) -> DataFrame:
    lo, hi = F.col("salary_usd_year_min"), F.coalesce("salary_usd_year_max", "salary_usd_year_min")
    rows = jobs.where(lo.isNotNull() & ~F.col(group).isin(*skip)).groupBy(group)
    return rows.agg(F.count("*").alias("jobs"), F.bround(F.percentile(((lo + hi) / 2).cast("double"), 0.5), 0).alias("median_usd_year")).orderBy(F.desc("median_usd_year"), group)


def salary_listing(jobs: DataFrame) -> DataFrame:
    shown = ("title", "company", "location", "role_family", "salary_usd_year_min", "salary_usd_year_max", "url")
    return jobs.where("salary_usd_year_min is not null").orderBy(F.desc("salary_usd_year_min"), "job_id").select("job_id", *shown)


def hit_lookup(hits: DataFrame, jobs: DataFrame, key: str = "job_id") -> DataFrame:
    """Search hits (key, rank, similarity) with their jobs, best first."""
    return hits.join(jobs, key).orderBy("rank")


def gap_ranking(matches: DataFrame, n: int = 8) -> DataFrame:
    """The skills most often missing in the matches."""
    return matches.select(F.explode("missing").alias("skill")).groupBy("skill").agg(F.count("*").alias("jobs")).orderBy(F.desc("jobs"), "skill").limit(n)
