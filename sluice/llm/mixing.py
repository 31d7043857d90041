"""Mixing sources to target weights by subset-sum budget fitting.

Sources in code point order (null last) weigh ``weights``, repeating, and share ``share`` of all words; a target
stops at ``max_repeat`` times its source's size and the excess is reshared by weight. A source whose target holds its
size r times gets r copies of every document. For the remaining budget, documents are counted by exact length; the
counts are thinned in proportion, longest first, which leaves less than the longest length, and a bounded-knapsack
program over all lengths changes counts until their words meet the budget or nothing comes nearer from below. Of each
length the documents with the smallest seeded hashes are selected.

The program goes through every sum up to ``WHOLE`` words, so there its result is the best that can be reached. Above,
it goes through the sums within a window of WHOLE words (or 4 times the longest length) about the budget; what it
leaves is then under the shortest length that can be exchanged in it. Lengths are divided by their common divisor.

Scale: documents are reduced to counts by (source, length) before anything meets; sources are ranked by ranges, not in
one task; the n-th smallest hash of a length is found by descending through counts of hash ranges (128 a step) and of
single hashes, so a length that many rows share is never sorted in one task. The program runs by source on its
distinct lengths, which are as many as the square root of twice its words at most.

Defined cases: null and empty texts have size 0 and take no words; the hash is of id, text and source, so rows with a
null or repeated id are chosen like others, and of rows equal in all three as many as are due, whichever; a null source
is a source of its own, the last; an empty table gives an empty result; an input column named like an output (size,
source_size, target, taken, copies) is replaced; other columns pass through.
"""

from __future__ import annotations

from math import gcd

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sluice.llm.common import NOT_SPACE, running, small, stored

SEED = 17
#: Words that the knapsack program spans; beyond, a window of them.
WHOLE = 1 << 22
#: Hashes are told apart by ranges of these shifts, one after another, then one by one.
SHIFTS = (57, 50, 0)
OUTPUTS = ("size", "source_size", "target", "copies", "taken")


def size_of(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(NOT_SPACE + "+")).cast("long")


def targets(sizes: DataFrame, weights=(1, 2, 3), share: float = 1.0, max_repeat: int = 3) -> DataFrame:
    """``sizes`` (source, source_size), one row a source -> with idx (rank of the source) and target."""
    ranked = running(sizes.select("source", "source_size"), [F.col("source").asc_nulls_last()]).withColumnRenamed("rank", "idx")
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("idx") - 1) % len(weights) + 1).cast("int"))
    ranked = ranked.withColumns({"weight": weight, "cap": F.col("source_size") * max_repeat}).withColumn("ratio", F.col("cap") / F.col("weight"))
    # In the order of their caps by weight the sources before one are full; the water level is where that stops being so.
    poured = running(ranked, [F.col("ratio"), F.col("idx")], full="cap", light="weight").drop("rank")
    poured = stored(poured, "poured")
    words, heavy = poured.agg(F.sum("source_size"), F.sum("weight")).first()
    left, of = F.lit((words or 0) * share) - F.col("full"), F.lit(heavy or 0) - F.col("light")
    level = F.max(F.when(F.col("weight") * left / of <= F.col("cap"), F.struct((left / of).alias("l"), left.alias("left"), of.alias("of"))))
    level = poured.agg(level.alias("level")).first()["level"]
    cap = F.col("cap").cast("double")
    target = cap if level is None else F.least(cap, F.col("weight") * F.lit(float(level["left"])) / F.lit(float(level["of"])))
    return poured.select("source", "source_size", F.col("idx").cast("long").alias("idx"), target.alias("target"))


def fit_budget(lengths, counts, budget: int, whole: int = WHOLE) -> list[int]:
    """How many documents of each length to take, so that their words come as near to ``budget`` from below as can be."""
    total = sum(n * c for n, c in zip(lengths, counts, strict=True))
    if budget >= total:
        return list(counts)
    step = gcd(*lengths)
    lengths, total, budget = [n // step for n in lengths], total // step, budget // step
    order, take = sorted(range(len(lengths)), key=lambda i: -lengths[i]), [0] * len(lengths)
    spent = seen = 0
    for i in order:
        seen += lengths[i] * counts[i]
        take[i] = min(counts[i], max(0, (budget * seen // total - spent) // lengths[i]))
        spent += take[i] * lengths[i]
    if spent == budget:
        return take
    around = max(whole // 2, 2 * lengths[order[0]])
    low, high = (0, total) if total <= whole else (max(0, budget - around), min(total, budget + around))
    goal = budget - low
    # first[s]: the step by which the sum low + s came to be reached.
    reach, first, steps = np.zeros(high - low + 1, bool), np.full(high - low + 1, -1, np.int32), []
    reach[spent - low] = True
    turns = dict.fromkeys(i for pair in zip(order, order[::-1], strict=True) for i in pair)  # the longest and the shortest in turn
    for i, n in _parts(turns, lengths, counts, take, len(reach) - 1):
        if reach[goal]:
            break
        move = abs(n) * lengths[i]
        fresh = np.flatnonzero(reach[:-move] & ~reach[move:]) + move if n > 0 else np.flatnonzero(reach[move:] & ~reach[:-move])
        if len(fresh):
            reach[fresh], first[fresh] = True, len(steps)
            steps.append((i, n))
    at = int(np.flatnonzero(reach[: goal + 1])[-1])
    while first[at] >= 0:
        i, n = steps[first[at]]
        take[i] += n
        at -= n * lengths[i]
    return take


def _parts(turns, lengths, counts, take, width: int):
    """(length, documents to add or, negative, to take back): powers of two make every number up to what there is."""
    for i in turns:
        for sign, spare in ((1, counts[i] - take[i]), (-1, take[i])):
            spare, n = min(spare, width // lengths[i]), 1
            while spare > 0:
                n = min(n, spare)
                yield i, sign * n
                spare -= n
                n *= 2


def _fit(pdf: pd.DataFrame, whole: int) -> pd.DataFrame:
    pdf = pdf.sort_values("size", ignore_index=True)
    size, target = int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
    copies = int(target // size)
    extra = fit_budget(pdf["size"].tolist(), pdf["n"].tolist(), int(round(target - copies * size)), whole)
    return pd.DataFrame({"idx": pdf["idx"], "size": pdf["size"], "n": pdf["n"], "base": np.int64(copies), "extra": np.array(extra, np.int64)})


def plan(narrow: DataFrame, aims: DataFrame, whole: int = WHOLE) -> DataFrame:
    """(source, size, base, cut, due, ties): a document is taken base times, and once more if its hash is under cut;
    of the ``ties`` documents at cut, ``due`` are. ``narrow`` has source, size and hash of every document."""
    counts = narrow.groupBy("source", "size").agg(F.count("*").alias("n")).where("size > 0")
    aimed = counts.alias("c").join(small(aims).alias("t"), F.expr("c.source <=> t.source")).select("idx", "size", "n", "source_size", "target")

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        return _fit(pdf, whole)

    fitted = stored(aimed.groupBy("idx").applyInPandas(fit, "idx long, size long, n long, base long, extra long"), "fitted")
    rows = narrow.alias("d").join(small(aims.select("source", "idx")).alias("t"), F.expr("d.source <=> t.source")).select("idx", "size", "hash")
    some = fitted.where("extra > 0 and extra < n").select("idx", "size", F.col("extra").alias("due"))
    keys = ["idx", "size"]
    for shift in SHIFTS:
        rows = rows.withColumn(f"at{shift}", F.shiftright("hash", shift) if shift else F.col("hash"))
        counted = rows.join(small(some), keys).groupBy(*keys, "due", f"at{shift}").agg(F.count("*").alias("m"))
        upto = F.sum("m").over(W.partitionBy(*keys).orderBy(f"at{shift}"))
        edge = counted.withColumn("upto", upto).where("upto >= due and upto - m < due")
        keys = [*keys, f"at{shift}"]
        some = stored(edge.select(*keys, (F.col("due") - F.col("upto") + F.col("m")).alias("due"), *(["m"] if not shift else [])), "edges")
    cuts = some.select("idx", "size", F.col("at0").alias("cut"), "due", F.col("m").alias("ties"))
    full = fitted.join(cuts, ["idx", "size"], "left")
    all_of_it = F.col("extra") == F.col("n")
    full = full.select("idx", "size", "base", F.when(all_of_it, F.lit((1 << 63) - 1)).otherwise(F.col("cut")).alias("cut"), F.when(all_of_it, 1).otherwise(F.col("due")).alias("due"), F.when(all_of_it, 1).otherwise(F.col("ties")).alias("ties"))
    return stored(full.join(aims.select("idx", "source"), "idx").select("source", "size", "base", "cut", "due", "ties"), "plan")


def _numbered(tied: DataFrame) -> DataFrame:
    """Documents at their length's cut, of which only ``__due`` are taken: they are equal, so any numbering does. They
    are written down with the partition they are in, and numbered within it."""
    tied = stored(tied.withColumn("__part", F.spark_partition_id()), "ties")
    same = ["__source", "size"]
    held = tied.groupBy(*same, "__part").agg(F.count("*").alias("m"))
    before = F.sum("m").over(W.partitionBy(*same).orderBy("__part")) - F.col("m")
    held = small(stored(held.withColumn("__before", before).drop("m"), "held")).alias("h")
    number = F.row_number().over(W.partitionBy(*same, "__part").orderBy("__hash")) + F.col("__before")
    joined = tied.alias("t").join(held, F.expr("t.__source <=> h.__source and t.size = h.size and t.__part = h.__part")).select("t.*", "__before")
    return joined.withColumn("__extra", (number <= F.col("__due")).cast("long")).drop("__part", "__before")


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=(1, 2, 3), share: float = 1.0, max_repeat: int = 3, seed: int = SEED, whole: int = WHOLE) -> DataFrame:
    """``docs`` with size, source_size, target (of its source), copies (times the document is in the mix) and
    taken (its words in the mix)."""
    docs = docs.drop(*(c for c in OUTPUTS if c in docs.columns and c not in (id_col, text_col, source_col)))
    hashed = F.xxhash64(F.col(id_col).cast("string"), text_col, source_col, F.lit(seed))
    narrow = stored(docs.select(F.col(source_col).alias("source"), size_of(F.col(text_col)).alias("size"), hashed.alias("hash")), "sizes")
    aims = stored(targets(narrow.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, max_repeat), "targets")
    planned = plan(narrow, aims, whole)
    named = docs.withColumns({"__source": F.col(source_col), "size": size_of(F.col(text_col)), "__hash": hashed}).alias("d")
    joined = named.join(small(aims).alias("t"), F.expr("d.__source <=> t.source"), "left").join(small(planned).alias("p"), F.expr("d.__source <=> p.source and d.size = p.size"), "left")
    at, under = F.col("d.__hash") == F.col("p.cut"), F.col("d.__hash") < F.col("p.cut")
    extra = F.when(F.col("p.cut").isNull(), 0).when(under | at & (F.col("p.due") == F.col("p.ties")), 1).when(~at, 0).cast("long")
    out = joined.select("d.*", F.col("t.source_size").alias("source_size"), F.col("t.target").alias("target"), F.coalesce("p.base", F.lit(0)).cast("long").alias("__base"), extra.alias("__extra"), F.col("p.due").alias("__due"))
    if not planned.where("due < ties").isEmpty():
        out = out.where("__extra is not null").unionByName(_numbered(out.where("__extra is null")))
    out = out.withColumn("copies", F.col("__base") + F.col("__extra"))
    return out.withColumn("taken", F.col("size") * F.col("copies")).drop("__source", "__hash", "__base", "__extra", "__due")
