"""Document vectors: delta sync, exact cosine search, retrieve-then-rerank matching.

The embedder is a plug-in (DataFrame with a text column -> with embedding). The default hashes words into a fixed
number of weighted, signed dimensions and scales to length 1, all in built-in functions; it stands in for a model.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sluice.functions import fixed, nearest, skills, text

DIMENSIONS = 256
#: Queries and vectors that meet in one task, about; pairs for which another task is worth while.
BLOCK, VECTORS, PAIRS = 5000, 1 << 17, 1 << 22
Embedder = Callable[[DataFrame, str, str], DataFrame]


def hashed_embedding(frame: DataFrame, text_col: str, out: str = "embedding", size: int = DIMENSIONS) -> DataFrame:
    words = F.array_remove(F.split(F.lower(F.coalesce(text_col, F.lit(""))), r"[^\p{L}\p{N}+#]+"), "")
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    zero = F.array_repeat(F.lit(0.0), size)

    def add(acc: Column, h: Column) -> Column:
        at = F.pmod(h, F.lit(size)).cast("int")
        sign = F.when(F.shiftright(h, 40) % 2 == 0, 1.0).otherwise(-1.0)
        return F.concat(F.slice(acc, 1, at), F.array(F.element_at(acc, at + 1) + sign), F.slice(acc, at + 2, F.lit(size)))

    summed = F.aggregate(hashes, zero, add)
    norm = F.sqrt(F.aggregate("__v", F.lit(0.0), lambda a, x: a + x * x))
    scaled = F.transform("__v", lambda x: (x / F.greatest("__n", F.lit(1e-12))).cast("float"))
    return frame.withColumn("__v", summed).withColumn("__n", norm).withColumn(out, scaled).drop("__v", "__n")


def documents(jobs: DataFrame, silver: DataFrame) -> DataFrame:
    """(job_id, document, doc_hash) of what is to be embedded."""
    joined = jobs.join(silver.select("job_id", "description"), "job_id")
    doc = text.job_document(F.col("title"), F.col("skills"), F.col("description"))
    return joined.select("job_id", doc.alias("document")).withColumn("doc_hash", text.short_hash(F.col("document")))


def delta(existing: DataFrame, wanted: DataFrame, key: str = "job_id") -> DataFrame:
    """(key, action): add (new or changed), keep or remove."""
    old = existing.select(key, F.col("doc_hash").alias("old"))
    new = wanted.select(key, F.col("doc_hash").alias("new"))
    action = F.when(F.col("new").isNull(), "remove").when(F.col("old").eqNullSafe(F.col("new")), "keep").otherwise("add")
    return old.join(new, key, "full_outer").select(key, action.alias("action"))


def sync(existing: DataFrame, wanted: DataFrame, embed: Embedder = hashed_embedding) -> tuple[DataFrame, DataFrame]:
    """(next vector snapshot, one row added and removed). Only new and changed documents are embedded."""
    actions = delta(existing, wanted)
    todo = wanted.join(actions.where("action = 'add'").select("job_id"), "job_id", "left_semi")
    kept = existing.join(actions.where("action = 'keep'").select("job_id"), "job_id", "left_semi")
    fresh = embed(todo, "document", "embedding").select(*existing.columns)
    counts = actions.agg(F.count_if(F.col("action") == "add").alias("added"), F.count_if(F.col("action") == "remove").alias("removed"))
    return kept.unionByName(fresh), counts


def search(vectors: DataFrame, queries: DataFrame, n: int = 10, where: Column | None = None, key: str = "job_id", query_key: str = "query_id", block: int = BLOCK) -> DataFrame:
    """(query_key, key, rank, similarity): for each query the n nearest by exact cosine, ties to the smaller key.

    Queries and vectors are dealt into blocks of at most about ``block`` and ``VECTORS``; every block of the ones meets
    every block of the others in a task of bounded memory, and the top n of each task meet in the final ranking."""
    vectors = vectors if where is None else vectors.where(where)
    found, asked = vectors.select(key, "embedding"), queries.select(query_key, F.col("embedding").alias("__q"))
    across, down = blocks(found.count(), asked.count(), block, vectors.sparkSession.sparkContext.defaultParallelism)
    part, each = lambda k, number: F.pmod(F.xxhash64(k), F.lit(number).cast("long")), lambda number: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(number - 1).cast("long")))
    found = found.select(key, "embedding", part(key, across).alias("__across"), each(down).alias("__down"))
    asked = asked.select(query_key, "__q", part(query_key, down).alias("__down"), each(across).alias("__across"))
    kinds = dict(found.dtypes) | dict(asked.dtypes)

    def task(some: pa.Table, others: pa.Table) -> pa.Table:
        return nearest.nearest(some.select([query_key, "__q"]), others.select([key, "embedding"]), n).rename_columns([query_key, key, "exact"])

    cells = asked.groupBy("__across", "__down").cogroup(found.groupBy("__across", "__down"))
    pairs = cells.applyInArrow(task, f"`{query_key}` {kinds[query_key]}, `{key}` {kinds[key]}, exact double")
    order = W.partitionBy(query_key).orderBy(F.desc("exact"), key)
    ranked = pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
    return ranked.select(query_key, key, "rank", F.round("exact", 3).alias("similarity"), "exact")


def blocks(vectors: int, queries: int, block: int, cores: int) -> tuple[int, int]:
    """How many blocks of vectors and of queries: as many as their sizes ask for, and more where cores would be idle."""
    across, down = max(1, -(-vectors // VECTORS)), max(1, -(-queries // block))
    more = min(2 * cores, vectors * queries // PAIRS) / (across * down)
    times = math.ceil(math.sqrt(more)) if more > 1 else 1
    return across * times, down * times


def semantic_scores(hits: DataFrame, key: str = "job_id", query_key: str = "query_id") -> DataFrame:
    """(key, semantic): mean of a key's two best hits (of one, if it has one)."""
    best = F.row_number().over(W.partitionBy(key).orderBy(F.desc("exact"), query_key))
    return hits.withColumn("rn", best).where("rn <= 2").groupBy(key).agg(F.avg("exact").alias("semantic"))


def match(resume: DataFrame, vectors: DataFrame, jobs: DataFrame, n: int = 15, candidates: int = 60, embed: Embedder = hashed_embedding) -> DataFrame:
    """Jobs for one resume (text): half semantic, half coverage of the job's skills; non-technical roles are left out."""
    chunks = resume.select(F.posexplode(text.chunk_text(F.col("text"))).alias("query_id", "chunk"))
    hits = search(vectors, embed(chunks, "chunk", "embedding"), candidates)
    shortlist = semantic_scores(hits).orderBy(F.desc("semantic"), "job_id").limit(candidates)
    own = resume.select(skills.keyword_skills(F.col("text")).alias("own"))
    joined = jobs.where("role_family <> 'other'").join(shortlist, "job_id").join(F.broadcast(own))  # one row
    wanted = F.coalesce("skills", F.array().cast("array<string>"))
    covered = skills.coverage(wanted, F.col("own"))
    score = fixed.SEMANTIC_WEIGHT * F.col("semantic") + (1 - fixed.SEMANTIC_WEIGHT) * covered
    out = joined.select(
        "job_id", "title", "company", "location", "role_family", "seniority", "url", "salary_usd_year_min", "salary_usd_year_max",
        F.round("semantic", 3).alias("semantic"), F.round(covered, 3).alias("coverage"), F.round(score, 3).alias("score"),
        skills.matched(wanted, F.col("own")).alias("matched"), skills.missing(wanted, F.col("own")).alias("missing"),
    )
    return out.orderBy(F.desc("score"), "job_id").limit(n)
