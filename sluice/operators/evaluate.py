"""Extraction metrics over records with gold and predicted values side by side."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions import fixed, skills, text
from sluice.operators import enrich


def set_scores(rows: DataFrame, gold: str = "gold", pred: str = "pred") -> DataFrame:
    """One row: micro-averaged precision, recall, f1 (3 decimals, 0 where undefined) and tp, fp, fn."""
    g, p = F.array_distinct(gold), F.array_distinct(pred)
    counts = rows.agg(
        F.coalesce(F.sum(F.size(F.array_intersect(g, p))), F.lit(0)).alias("tp"),
        F.coalesce(F.sum(F.size(F.array_except(p, g))), F.lit(0)).alias("fp"),
        F.coalesce(F.sum(F.size(F.array_except(g, p))), F.lit(0)).alias("fn"),
    )
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    precision, recall = ratio(tp, tp + fp), ratio(tp, tp + fn)
    return counts.select(F.round(precision, 3).alias("precision"), F.round(recall, 3).alias("recall"), F.round(ratio(2 * precision * recall, precision + recall), 3).alias("f1"), "tp", "fp", "fn")


def accuracy(rows: DataFrame, gold: str = "gold", pred: str = "pred") -> DataFrame:
    """One row: share of equal values among rows whose gold is given; NULL if none is."""
    given = rows.where(F.col(gold).isNotNull() & (F.col(gold).cast("string") != ""))
    return given.agg(F.round(F.avg(F.col(gold).eqNullSafe(F.col(pred)).cast("int")), 3).alias("accuracy"))


def per_skill_errors(rows: DataFrame, gold: str = "gold", pred: str = "pred", top: int = 10) -> DataFrame:
    """(kind, skill, n): the skills most often invented and most often missed."""

    def side(kind: str, extra: Column) -> DataFrame:
        counted = rows.select(F.explode(extra).alias("skill")).groupBy("skill").agg(F.count("*").alias("n"))
        return counted.orderBy(F.desc("n"), "skill").limit(top).select(F.lit(kind).alias("kind"), "skill", "n")

    return side("false_positive", F.array_except(pred, gold)).union(side("false_negative", F.array_except(gold, pred)))


def seeded_sample(rows: DataFrame, n: int, seed: int = 42, key: str = "job_id") -> DataFrame:
    """min(n, rows) rows, the same for a seed whatever the partitioning."""
    return rows.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary")), key).limit(n)


def sample_for_labels(silver: DataFrame, n: int = 50, seed: int = 42, least: int = fixed.LABELLED_CHARS) -> DataFrame:
    """LABELS of a seeded sample of unique tech jobs whose description is long enough, with the excerpt a model sees."""
    rows = silver.where(F.col("is_tech") & ~F.col("is_duplicate") & (F.char_length("description") > least))
    rows = rows.withColumn("id", F.concat_ws(":", "source", "source_job_id"))
    none = F.array().cast("array<string>")
    return seeded_sample(rows, n, seed, "id").select(
        "id", "title", "company", "location", text.llm_excerpt(F.col("description")).alias("text"), F.lit(False).alias("labelled"),
        none.alias("skills"), F.lit("").alias("role_family"), F.lit("").alias("seniority"))


def label(record: dict, ask: Callable[[str], str], known: Callable[[str], str | None]) -> dict:
    """A record with the labels that ``ask`` gives; names that aren't ``known`` are passed over."""
    def choice(what: str, options) -> str:
        while (given := ask(f"{what} ({', '.join(options)}): ").strip()) not in options:
            pass
        return given

    names = [known(x) for x in ask(f"{record['title']}\n\n{record['text']}\n\nskills, parted by commas: ").split(",")]
    made = {"skills": sorted({x for x in names if x}), "role_family": choice("role family", fixed.ROLE_FAMILIES), "seniority": choice("seniority", fixed.SENIORITIES)}
    return record | made | {"labelled": True}


def evaluate(labels: DataFrame, model: Callable | None = None, model_name: str = "none", **options) -> dict:
    """Scores of the dictionary and, if there is one, of ``model`` on the labelled records."""
    rows = labels.where("labelled").withColumn("job_id", F.xxhash64("id").bitwiseAND(F.lit((1 << 63) - 1)))
    rows = rows.withColumn("keyword", skills.keyword_skills(F.concat("title", F.lit("\n"), "text")))
    queue = rows.select("job_id", F.lit("").alias("content_hash"), "title", "company", "location", F.col("text").alias("description"), F.lit(None).cast("timestamp").alias("posted_at"))
    found, counts = enrich.extract(queue, model, model_name, F.current_timestamp(), **options)
    found = found.select("job_id", F.col("skills").alias("model_skills"), F.col("role_family").alias("model_role"), F.col("seniority").alias("model_seniority"))
    none = F.array().cast("array<string>")
    both = rows.join(found, "job_id", "left").withColumn("model_skills", F.coalesce("model_skills", none)).withColumn("skills", F.coalesce("skills", none))
    report: dict = {"jobs": both.count(), "model": model_name, "answered": counts["extracted"], "skills": {}, "errors": {}}
    for name, column in (("keyword", "keyword"), ("model", "model_skills")):
        report["skills"][name] = set_scores(both, "skills", column).first().asDict()
        report["errors"][name] = [r.asDict() for r in per_skill_errors(both, "skills", column).collect()]  # at most twice ten rows
    for name, column in (("role_family", "model_role"), ("seniority", "model_seniority")):
        report[f"{name}_accuracy"] = accuracy(both, name, column).first()[0]
    return report


def write_report(report: dict, path: str) -> None:
    """results.json and results.md in a local folder."""
    with open(f"{path}/results.json", "w", encoding="utf-8") as out:
        json.dump(report, out, ensure_ascii=False, indent=2)
    lines = [f"{report['jobs']} labelled jobs, model {report['model']}, {report['answered']} answered.", "", "| extractor | precision | recall | F1 |", "|---|---|---|---|"]
    lines += [f"| {k} | {v['precision']} | {v['recall']} | {v['f1']} |" for k, v in report["skills"].items()]
    lines += ["", *(f"{n}: {report[f'{n}_accuracy']}" for n in ("role_family", "seniority")), ""]
    lines += [f"{name}, {r['kind']}: {r['skill']} ({r['n']})" for name, rows in report["errors"].items() for r in rows]
    with open(f"{path}/results.md", "w", encoding="utf-8") as out:
        out.write("\n".join(lines) + "\n")
