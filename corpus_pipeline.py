"""The training-corpus pipeline (part of subpackage llm): documents in, token ids out.

Each stage takes what its predecessor kept, written as Parquet and read again. Texts are judged whole. Columns that
documents have beyond the stages' own pass through all stages, whatever their names: those that are named like a column
that an operator makes are set aside while it runs. The last stage adds its outputs and replaces columns named so.

Scratch tables of a stage go when the next one begins, as its result is written by then.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import language_id, mixing, sentence_pieces, simhash, suffix_dedup
from sluice.llm.common import scratch, small, stored, workspace

#: Documents whose most probable language is less probable than this are rejected, like those without a letter.
LEAST_SCORE = 0.3
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keeping(*made: str) -> Callable[[Stage], Stage]:
    """A stage whose result has just the columns of its input; input columns named like one of ``made`` are set aside."""

    def wrap(stage: Stage) -> Stage:
        @wraps(stage)
        def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            aside = {c: f"__own_{k}" for k, c in enumerate(docs.columns) if c in made or c.startswith("__")}
            with workspace(spark, "stage"):
                done = stage(spark, docs.withColumnsRenamed(aside), sf_dir)
            return done.select(*(F.col(f"`{aside.get(c, c)}`").alias(c) for c in docs.columns))

        return run_stage

    return wrap


@keeping("held_out", "lang_pred", "score")
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents of no recognised language: those whose text is null, empty or without a letter, and those whose
    most probable language is less probable than LEAST_SCORE. Very long texts are judged whole. Of equally probable
    languages the first by name counts, which changes no decision. Rows repeated with one id are judged each by its own
    text. An empty table, or one without a label to learn from, keeps nothing."""
    judged = language_id.identify(docs)
    return judged.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SCORE))


@keeping("component_id")
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of exact and near copies (five-word shingles, similarity of at least 0.8) the document with the
    smallest id stays. Links of SimHash fingerprints, and min-hash bands for copies too far apart for those, say which texts
    meet; the shingles decide. Rows repeated with one id stay or go together; rows without id stay. Null and empty texts are
    copies of one another, and so are texts with the same words. Very long texts are compared whole; an empty table gives an empty result."""
    groups = simhash.near_copies(docs)
    gone = stored(groups.where("doc_id <> component_id").select("doc_id").distinct(), "copies")
    return docs.join(small(gone), "doc_id", "left_anti")


@keeping("kept", "removed")
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes passages of 50 bytes and more that a document with a smaller id has; a document that loses all its text
    goes. Bytes that a cut leaves of a broken character go too, and n_chars follows the text. Null and empty texts, and
    texts of rows without id, stay as they are; rows repeated with one id don't count against each other; of equal texts
    the smallest id's stays whole; an empty table gives an empty result."""
    cut = suffix_dedup.remove_repeats(docs)
    left = F.col("kept").cast("string")
    clean = F.when(F.is_valid_utf8(left), left).otherwise(F.replace(F.make_valid_utf8(left), F.lit("�"), F.lit("")))
    touched = F.size("removed") > 0
    cut = cut.where(~touched | (F.octet_length("kept") > 0)).withColumn("text", F.when(touched, clean).otherwise(F.col("text")))
    return cut.withColumn("n_chars", F.when(touched, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))


@keeping(*mixing.OUTPUTS, "copy")
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it, so its rows repeat. Texts without a word (null, empty) take no
    words and so go; a null source is a source of its own; rows with null or repeated ids are chosen like others; of equal
    rows as many stay as are due; an empty table gives an empty result."""
    mixed = mixing.mix_sources(docs).where("copies > 0")
    return mixed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with token_ids, n_tokens, ids_sha256, decoded_sha256 and lossless in place of their text. Null and
    empty texts have no tokens; texts of any length are encoded whole; repeated rows each get a row; input columns named
    like an output are replaced; an empty table gives an empty result."""
    return sentence_pieces.encode(docs).drop("text")


STAGES = [
    ("language ID", identify_language),
    ("SimHash near-dedup", drop_near_copies),
    ("suffix-array dedup", cut_repeats),
    ("mixing", mix),
    ("SentencePiece", encode),
]
#: Seeded choices and models can't be put in SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over the table documents, each written and read again; tokens of what is left."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
