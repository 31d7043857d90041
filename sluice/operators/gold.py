"""Aggregates for analysis and their publication as snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions import moment


def with_extractions(silver: DataFrame, extractions: DataFrame) -> DataFrame:
    """Left join on job and content, so an extraction of an older text doesn't count. ``e`` is the extraction or NULL."""
    fields = ("role_family", "seniority", "years_experience_min", "remote_policy", "skills")
    current = extractions.select("job_id", "content_hash", F.struct(*fields).alias("e"))
    return silver.join(current, ["job_id", "content_hash"], "left")


def jobs_enriched(silver: DataFrame, extractions: DataFrame) -> DataFrame:
    """One row for each unique tech job, model fields with fallbacks."""
    joined = with_extractions(silver.where("is_tech and not is_duplicate"), extractions)
    enriched = F.col("e").isNotNull()
    return joined.select(
        "job_id", "source", "title", "company", "location", "country", "is_remote", "employment_type",
        "salary_usd_year_min", "salary_usd_year_max", "posted_at", "url",
        F.coalesce("e.role_family", F.lit("unknown")).alias("role_family"),
        F.coalesce("e.seniority", F.lit("unknown")).alias("seniority"),
        F.col("e.years_experience_min").alias("years_experience_min"),
        F.coalesce("e.remote_policy", F.when(F.col("is_remote"), "remote").otherwise("unknown")).alias("remote_policy"),
        F.when(enriched, F.col("e.skills")).otherwise(F.col("keyword_skills")).alias("skills"),
        enriched.alias("llm_enriched"),
        moment.week_of(F.col("posted_at"), F.col("updated_at")).alias("week"),
    )


def skill_demand(jobs: DataFrame, group: str = "role_family", items: str = "skills", key: str = "job_id", item: str = "skill", count: str = "jobs") -> DataFrame:
    """(group, item, count, pct): distinct keys with the item by group and over all ('all'); pct of the group's rows,
    those without items included."""
    share = f"pct_of_{count}"
    named = F.when(F.grouping(F.col(group)) == 1, "all").otherwise(F.col(group)).alias("g")
    totals = jobs.rollup(group).agg(F.count("*").alias("total"), named).select("g", "total")
    spark = jobs.sparkSession
    exploded = jobs.select(F.col(group).alias("grp"), F.col(key).alias("k"), F.explode(items).alias("item")).where("item is not null")
    sql = "SELECT CASE WHEN grouping(grp) = 1 THEN 'all' ELSE grp END AS g, item, count(DISTINCT k) AS n FROM {rows} GROUP BY GROUPING SETS ((grp, item), (item))"
    counted = spark.sql(sql, rows=exploded)
    joined = counted.alias("c").join(totals.alias("t"), F.expr("c.g <=> t.g"))
    return joined.select(F.col("c.g").alias(group), F.col("item").alias(item), F.col("n").alias(count), F.round(100.0 * F.col("n") / F.col("total"), 1).cast("double").alias(share))


def skill_demand_weekly(jobs: DataFrame, week: str = "week", items: str = "skills", key: str = "job_id") -> DataFrame:
    totals = jobs.groupBy(week).agg(F.count("*").alias("total"))
    counted = jobs.select(week, key, F.explode(items).alias("skill")).groupBy(week, "skill").agg(F.count_distinct(key).alias("jobs"))
    return counted.join(totals, week).select(week, "skill", "jobs", F.round(100.0 * F.col("jobs") / F.col("total"), 1).cast("double").alias("pct_of_jobs"))


def salary_by_role(jobs: DataFrame, groups=("role_family", "seniority")) -> DataFrame:
    """Exact medians of the midpoints of stated salaries."""
    lo, hi = F.col("salary_usd_year_min"), F.coalesce("salary_usd_year_max", "salary_usd_year_min")
    return (
        jobs.where(lo.isNotNull())
        .groupBy(*groups)
        .agg(
            F.count("*").alias("jobs_with_salary"),
            F.round(F.percentile(((lo + hi) / 2).cast("double"), 0.5), 0).alias("median_usd_year"),
            F.round(F.min(lo), 0).alias("min_usd_year"),
            F.round(F.max(hi), 0).alias("max_usd_year"),
        )
    )


def source_summary(silver: DataFrame, extractions: DataFrame) -> DataFrame:
    return (
        with_extractions(silver, extractions)
        .groupBy("source")
        .agg(
            F.count("*").alias("jobs"),
            F.count_if("is_tech").alias("tech_jobs"),
            F.count_if("is_duplicate").alias("duplicates"),
            F.count("e").alias("llm_enriched"),
            F.count_if(F.col("salary_usd_year_min").isNotNull()).alias("with_salary"),
            F.max("posted_at").alias("latest_posting"),
        )
    )


TABLES = ("jobs_enriched", "skill_demand", "skill_demand_weekly", "salary_by_role", "source_summary")


def build(silver: DataFrame, extractions: DataFrame) -> dict[str, DataFrame]:
    jobs = jobs_enriched(silver, extractions)
    return dict(zip(TABLES, (jobs, skill_demand(jobs), skill_demand_weekly(jobs), salary_by_role(jobs), source_summary(silver, extractions)), strict=True))


def publish(spark: SparkSession, tables: dict[str, DataFrame], root: str, version: int) -> None:
    """Writes all tables under a new version and then makes it current, with one small commit. What is read until then
    is the version before; a blocked run changes nothing."""
    for name, frame in tables.items():
        frame.write.parquet(f"{root}/v{version}/{name}")
    spark.createDataFrame([(version,)], "version long").coalesce(1).write.mode("append").parquet(f"{root}/current")


def published(spark: SparkSession, root: str, name: str) -> DataFrame:
    version = spark.read.schema("version long").parquet(f"{root}/current").agg(F.max("version")).first()[0]
    return spark.read.parquet(f"{root}/v{version}/{name}")
