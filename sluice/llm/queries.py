"""The ten operators applied to their whole tables, and SQL for those that SQL can state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import language_id, license_scan, mixing, multi_index, quality_rules, sentence_pieces, simhash, suffix_dedup, url_filter, warc
from sluice.llm.common import scratch

URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    judged = url_filter.filter_urls(read(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", *url_filter.OUTPUTS)


def op2_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.encode(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select(F.col("page_id").alias("key"), F.col("url").alias("uri"), F.col("html").alias("payload"))
    path = scratch(spark, "archives")
    warc.write_archives(warc.choose(pages), path)
    found = warc.resolve_revisits(warc.read_archives(spark, path))
    return found.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return cut.select(
        "doc_id",
        n_bytes.alias("n_bytes"),
        (n_bytes - F.octet_length("kept")).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.apply_quality_rules(docs).select("doc_id", *quality_rules.COUNTS, "base_failed", "kept")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of a tree: source/lang/hundred/doc_id.txt; every tenth is named as its folder's licence file."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    folder = F.concat_ws("/", F.coalesce("source", F.lit("-")), F.coalesce("lang", F.lit("-")), F.floor(F.col("doc_id") / 100).cast("string"))
    path = F.concat(folder, F.when(F.col("doc_id") % 10 == 0, "/LICENSE.").otherwise("/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    return license_scan.scan(docs.select("doc_id", path.alias("path"), "text")).drop("text")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language_id.identify(docs).select("doc_id", "held_out", "lang_pred", "score")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(read(spark, sf_dir, "documents"), shingle=3, distance=2)


def op10_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    found = multi_index.nearest(vectors, vectors.where("vec_id % 100 = 0"), k=10)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


QUERIES = {f.__name__: f for f in (op1_url_filter, op2_sentence_pieces, op3_warc, op4_suffix_dedup, op5_quality_rules, op6_mixing, op7_license_scan, op8_language_id, op9_simhash, op10_multi_index)}

OP1_SQL = r"""
WITH u AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
r AS (SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM u)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM r
"""

OP5_SQL = (
    r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i+4], chr(10)) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)),
d AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g) WHERE n > 1),
p AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, i + j AS k FROM d, range(5) r(j)) GROUP BY doc_id),
c AS (
  SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(p.n, 0) AS BIGINT) AS n_repeat_words,
         len(l) AS n_lines,
         len(list_filter(l, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]'))) AS n_bullet_lines,
         length(t) - length(replace(t, '!', '')) AS n_exclamations,
         len(list_filter(regexp_split_to_array(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-zà-ÿ]+'),
                         lambda x: list_contains(["""
    + ", ".join(f"'{w}'" for w in quality_rules.STOP_WORDS)
    + r"""], x))) AS n_stop_words
  FROM w LEFT JOIN p ON p.doc_id = w.doc_id),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * word_chars >= 200 * n_words AND 100 * word_chars <= 2000 * n_words
       AND 100 * n_symbols <= 10 * n_words AND 100 * n_exclamations <= 50 * n_words
       AND (100 * n_stop_words >= n_words OR n_words < 60)
       AND 100 * n_dup_lines <= 50 * n_lines AND 100 * n_bullet_lines <= 90 * n_lines AS kept
FROM b
"""
)

OP3_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages),
o AS (SELECT d, max(page_id) AS o FROM p WHERE n >= 1000 GROUP BY d HAVING count(*) > 1)
SELECT page_id, n AS payload_bytes, p.d AS payload_digest,
       CASE WHEN o.o IS NOT NULL AND page_id <> o.o THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> o.o THEN o.o END AS refers_to
FROM p LEFT JOIN o ON o.d = p.d
"""

ORACLES = {"op1_url_filter": OP1_SQL, "op3_warc": OP3_SQL, "op5_quality_rules": OP5_SQL}
