"""Quality rules: a threshold table compiled into one projection [DataFrame functions only].

``THRESHOLDS`` lists rules over counts that one pass of built-in functions makes from each whole text. A text is
kept if the base rule and every threshold hold. Counts are integers and limits are percentages of other counts,
so verdicts don't depend on rounding.

Repeats of 5-word windows are found by sorting 64-bit hashes of a text's own windows, which takes n log n steps
for any text; two different windows of one text hash alike once in about 2^64 pairs.

The limits, as percentages: words are 2 to 20 characters long on average; symbols are at most 10 and exclamation marks
at most 50 for 100 words; of a text's lines at most half repeat an earlier one and at most 90 in 100 are bullets; one
word in 100 is a stop word of the four languages, asked only of texts of 60 words and more, as shorter ones (titles,
captions, lists) often hold none. They are meant to reject junk and keep short clean texts; the table is a parameter.

Defined cases: a null text has no words (all counts 0, not kept); very long texts are taken whole; repeated rows
each get a row; an empty table gives an empty result; input columns named like an output are replaced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import NOT_SPACE, SPACE, lower_ascii, words_of

SYMBOLS = "#*$%&|<>"
WINDOW = 5
#: Frequent words of the four languages.
STOP_WORDS = (
    "the of and to in is that it with for was this have from be are by on as at "
    "le la les de des et un une du que qui en pour par est au dans sur "
    "der die das und zu mit von ist nicht auf ein eine dem den sich für "
    "el los las y del se con por una para no es lo su"
).split()
#: (name, count, "most" or "least" so many percent, of which count, for texts of at least so many words)
THRESHOLDS = (
    ("word_length_low", "word_chars", "least", 200, "n_words", 0),
    ("word_length_high", "word_chars", "most", 2000, "n_words", 0),
    ("symbols", "n_symbols", "most", 10, "n_words", 0),
    ("shouting", "n_exclamations", "most", 50, "n_words", 0),
    ("stop_words", "n_stop_words", "least", 1, "n_words", 60),
    ("duplicate_lines", "n_dup_lines", "most", 50, "n_lines", 0),
    ("bullet_lines", "n_bullet_lines", "most", 90, "n_lines", 0),
)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_lines", "n_bullet_lines", "n_exclamations", "n_stop_words")


def repeat_words(hashes: str, sorted_windows: str) -> Column:
    """How many word positions are in a window that occurs at least twice."""
    starts = F.array_sort(
        F.filter(
            F.transform(
                sorted_windows,
                lambda w, k: F.when((w["h"] == F.get(sorted_windows, k - 1)["h"]) | (w["h"] == F.get(sorted_windows, k + 1)["h"]), w["i"]),
            ),
            lambda i: i.isNotNull(),
        )
    )
    step = lambda acc, i: F.struct((acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n"), i.alias("last"))
    return F.aggregate(starts, F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")), step, lambda acc: acc["n"])


def compile_thresholds(table=THRESHOLDS) -> Column:
    """The verdict of all rules as one expression."""

    def rule(count, side, percent, of, words):
        held = F.col(count) * 100 <= F.col(of) * percent if side == "most" else F.col(count) * 100 >= F.col(of) * percent
        return held | (F.col("n_words") < words) if words else held

    return reduce(Column.__and__, (rule(*r[1:]) for r in table), F.lit(True))


def apply_quality_rules(docs: DataFrame, text_col: str = "text", table=THRESHOLDS, stop_words=STOP_WORDS) -> DataFrame:
    """``docs`` with the counts, base_failed and kept."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    made = docs.drop(*COUNTS, *MORE, "base_failed", "kept").withColumns({"__t": text, "__w": words_of(F.col(text_col))})
    made = made.withColumns(
        {
            "__lines": F.filter(F.split("__t", "\n"), lambda x: x.rlike(NOT_SPACE)),
            "__wh": F.transform("__w", lambda w: F.xxhash64(w)),
        }
    )
    # A window's hash is that of its words' hashes: each word is hashed once, and nothing is sliced.
    window = lambda i: F.xxhash64(*(F.get("__wh", i + k) for k in range(WINDOW)))
    some = F.transform(F.sequence(F.lit(0), F.size("__wh") - WINDOW), window)
    made = made.withColumn("__h", F.when(F.size("__wh") >= WINDOW, some).otherwise(F.array().cast("array<bigint>")))
    windows = F.transform("__h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    made = made.withColumn(
        "__s",
        F.when(F.size(F.array_distinct("__h")) < F.size("__h"), F.array_sort(windows)).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")),
    )
    counts = {
        "n_words": F.size("__w"),
        "word_chars": F.aggregate("__w", F.lit(0), lambda n, w: n + F.char_length(w)),
        "n_symbols": F.regexp_count("__t", F.lit(f"[{SYMBOLS}]")),
        "n_dup_lines": F.size("__lines") - F.size(F.array_distinct("__lines")),
        "n_repeat_words": repeat_words("__h", "__s"),
        "n_lines": F.size("__lines"),
        "n_bullet_lines": F.size(F.filter("__lines", lambda x: x.rlike(f"^{SPACE}*[-*•]"))),
        "n_exclamations": F.char_length("__t") - F.char_length(F.replace("__t", F.lit("!"), F.lit(""))),
        "n_stop_words": F.size(F.filter(F.split(lower_ascii(F.col("__t")), "[^a-zà-ÿ]+"), lambda w: w.isin(*stop_words))),
    }
    made = made.withColumns({k: v.cast("long") for k, v in counts.items()})
    made = made.withColumn("base_failed", (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20))
    return made.withColumn("kept", ~F.col("base_failed") & compile_thresholds(table)).drop("__t", "__w", "__lines", "__wh", "__h", "__s")
