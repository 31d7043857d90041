"""URL filters by host-suffix and path-prefix expressions [DataFrame functions only].

A rule (host, path, action) fits a URL whose host is the rule's or a subdomain of it and whose path starts with
the rule's path. Of several fitting rules the longest host + path wins (between equals the longer host); a rule
given twice blocks if either says so. A URL that no rule fits gets ``default``.

How: each distinct (host, path) is expanded into host suffixes x directory prefixes, as deep as the deepest rule
goes, so the work per row is bounded by the rules and not by the URL. The expressions are joined to the rules on
the first eight hex digits of their SHA-256, then the full digest of host + rule path is compared.

Defined cases: null URLs and URLs without ``://`` have empty host and path, which no rule fits; an empty table
gives an empty result; repeated rows each get a row; other columns are kept, and an input column named like an
output (host, path, rule, verdict) is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import lower_ascii, small

PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
SHORT = 8
OUTPUTS = ("host", "path", "rule", "verdict")


def url_host(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def digest(expression: Column) -> Column:
    return F.sha2(expression, 256)


def compile_rules(rules: DataFrame) -> DataFrame:
    """One row for each distinct rule: its string and action, label count, directory depth, and the digests of
    host + directory (for the join) and of host + path (for the confirmation)."""
    clean = rules.where("host is not null and path is not null and host <> '' and (path = '' or path like '/%')")
    clean = clean.groupBy(lower_ascii(F.col("host")).alias("host"), "path").agg(F.max("action").alias("action"))
    folder = F.regexp_extract("path", r"(?s)^.*/", 0)
    return clean.select(
        F.concat("host", "path").alias("rule"),
        "action",
        F.char_length("host").alias("host_len"),
        F.char_length("path").alias("path_len"),
        F.size(F.split("host", r"\.")).alias("labels"),
        (F.size(F.split(folder, "/")) - 1).alias("depth"),
        F.substring(digest(F.concat("host", folder)), 1, SHORT).alias("short"),
        digest(F.concat("host", "path")).alias("digest"),
    )


def expand(hosts: DataFrame, labels: int, depth: int, bare: bool) -> DataFrame:
    """Rows (host, path, suffix, short): one for each host suffix of up to ``labels`` labels and each directory
    prefix of up to ``depth`` slashes; ``bare`` adds the empty prefix."""
    parts = hosts.withColumn("h", F.split("host", r"\.")).withColumn("p", F.split("path", "/"))
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(F.size("h"), F.lit(labels))),
        lambda n: F.array_join(F.slice("h", F.size("h") - n + 1, n), "."),
    )
    folders = F.when(
        (F.size("p") > 1) & (F.lit(depth) > 0),
        F.transform(F.sequence(F.lit(1), F.least(F.size("p") - 1, F.lit(depth))), lambda n: F.concat(F.array_join(F.slice("p", 1, n), "/"), F.lit("/"))),
    ).otherwise(F.array().cast("array<string>"))
    if bare:
        folders = F.concat(F.array(F.lit("")), folders)
    parts = parts.select("host", "path", F.explode(suffixes).alias("suffix"), folders.alias("folders"))
    parts = parts.select("host", "path", "suffix", F.explode("folders").alias("folder"))
    return parts.select("host", "path", "suffix", F.substring(digest(F.concat("suffix", "folder")), 1, SHORT).alias("short"))


def filter_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule (host + path, or null) and verdict."""
    pages = pages.withColumns({"host": url_host(F.col(url_col)), "path": url_path(F.col(url_col))}).drop("rule", "verdict")
    compiled = compile_rules(rules)
    reach = compiled.agg(F.max("labels"), F.max("depth"), F.bool_or(F.col("depth") == 0)).first()  # one row
    if reach[0] is None:
        return pages.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    expanded = expand(pages.select("host", "path").where("host <> ''").distinct(), *reach)
    fits = F.col("digest") == digest(F.concat("suffix", F.expr("substring(path, 1, path_len)")))
    matched = (
        expanded.join(small(compiled), "short")
        .where((F.char_length("suffix") == F.col("host_len")) & fits)
        .groupBy("host", "path")
        .agg(F.max_by(F.struct("rule", "action"), F.struct(F.col("host_len") + F.col("path_len"), "host_len")).alias("best"))
        .select("host", "path", F.col("best.rule").alias("rule"), F.col("best.action").alias("verdict"))
    )
    return pages.join(matched, ["host", "path"], "left").withColumn("verdict", F.coalesce("verdict", F.lit(default)))
