"""Licence scans: sparse TF-IDF cosine to templates, then inheritance from the nearest folder [DataFrame functions only].

Templates are notices as headers state them, opening lines and paragraphs of licence files, and whole short licences.
What is compared with them, of every whole text:

- the text itself and its paragraphs, as headers and licence files are (where at least half of the words are words of
  the templates),
- its lines,
- its running words, across and inside lines: each window that lies over one of a template's anchors as the template
  does, for templates of up to ``WINDOWED`` words.

Words weigh their count times the product of two inverse document frequencies ln((1 + N) / (1 + df)) + 1: over the N
texts (a word outside the templates counts as held by one) and over the licences, so that "MIT" counts for more than
"licensed under". A file's licences are those that one of its units meets with a cosine of at least ``least``;
its own is the one with the best cosine, where whole licences (templates above WINDOWED words) go before notices, as
licences may open alike. A file without one inherits from the nearest folder above it that has a licence file (LICENSE,
LICENCE, COPYING, NOTICE, UNLICENSE, any ending) with a licence.

Units are found through anchors: a template's heaviest words, all but a tail whose norm is under ``least`` of the whole;
by Cauchy-Schwarz what shares only tail words stays under ``least``. For the same reason a window goes on only if the
template's words in it hold ``least`` of the template's norm. Equal units are scored once, so a notice that is in very
many texts costs one comparison.

Defined cases: null and empty texts have no licence of their own and may inherit; a null path has no folder, but the
licence of its own text; files that share a path have each the licence of its own text; ties go to the first licence by
name; of several licence files in a folder the best counts, then the first by name; repeated rows each get a row; very
long texts and lines are taken whole; an empty table gives an empty result; input columns named like an output are
replaced, all others pass through; templates of more than MOST_TERMS different words are refused.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sluice.llm.common import small, stored

LEAST, WINDOWED, MOST_TERMS = 0.75, 64, 20_000
WORD_GAP = "[^a-z0-9]+"
LICENSE_FILE = r"(?i)(^|/)(licen[cs]e|copying|notice|unlicense)[^/]*$"
OUTPUTS = ("license", "score", "origin", "folder")
IDS = ("AGPL-3.0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-2.0", "Unlicense")
GNU = "{0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1} as published by the Free Software Foundation, either version {2} of the License, or (at your option) any later version."
MIT_GRANT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
MIT_TEXT = MIT_GRANT + """ (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
ISC_TEXT = ISC_GRANT + """
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
BSD_GRANT = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
BSD_NAMES = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
BSD_CONDITIONS = BSD_GRANT + """
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
CREATIVE = (("CC-BY-4.0", "CC BY 4.0", "Attribution"), ("CC-BY-NC-4.0", "CC BY-NC 4.0", "Attribution-NonCommercial"), ("CC-BY-SA-4.0", "CC BY-SA 4.0", "Attribution-ShareAlike"))
#: (licence, text)
TEMPLATES = (
    *((i, f"SPDX-License-Identifier: {i}") for i in IDS),
    *((i, f"Licensed under {short}.") for i, short, _ in CREATIVE),
    *((i, f"This work is licensed under a Creative Commons {name} 4.0 International License.") for i, _, name in CREATIVE),
    *((i, GNU.format(what, name, v)) for i, name, v in (("GPL-2.0", "General Public License", "2"), ("GPL-3.0", "General Public License", "3"), ("LGPL-2.1", "Lesser General Public License", "2.1"), ("LGPL-3.0", "Lesser General Public License", "3"), ("AGPL-3.0", "Affero General Public License", "3")) for what in (("This library", "This program") if i[0] == "L" else ("This program",))),
    *((i, f"This work is licensed under the GNU General Public License, version {v}.") for i, v in (("GPL-2.0", 2), ("GPL-3.0", 3))),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at'),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", MIT_GRANT),
    ("MIT", MIT_TEXT),
    ("ISC", ISC_GRANT),
    ("ISC", ISC_TEXT),
    ("BSD-3-Clause", BSD_GRANT),
    ("BSD-2-Clause", BSD_CONDITIONS + "\n" + BSD_DISCLAIMER),
    ("BSD-3-Clause", BSD_NAMES),
    ("BSD-3-Clause", BSD_CONDITIONS + "\n3. " + BSD_NAMES + "\n" + BSD_DISCLAIMER),
)


def terms(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), WORD_GAP), "")


def key_of(path: Column, text: Column) -> Column:
    """What a file's own licence is joined back by: its path and its text."""
    return F.sha2(F.concat(F.coalesce(F.concat(F.lit("p"), path), F.lit("t")), F.lit("\n"), F.coalesce(text, F.lit(""))), 256)


def folder_of(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


class Vectors:
    """Templates as vectors: ``words`` (template, license, term, tf, w, norm, anchor), ``idf`` (term, idf) and what a
    word outside weighs. They are as large as the templates, which are checked."""

    def __init__(self, files: DataFrame, text_col: str, templates: DataFrame, least: float):
        named = templates.withColumn("template", F.concat_ws("\n", "license", "text")).distinct()
        self.templates = stored(named.select("license", "template", terms(F.col("text")).alias("terms")), "templates")
        counted = self.templates.select("license", "template", F.explode("terms").alias("term")).groupBy("license", "template", "term").agg(F.count("*").alias("tf"))
        listed = counted.select("term").distinct().orderBy("term").limit(MOST_TERMS + 1).collect()
        if len(listed) > MOST_TERMS:
            raise ValueError(f"templates hold more than {MOST_TERMS} different words")
        self.vocabulary = [r["term"] for r in listed]
        seen = F.array_intersect(terms(F.coalesce(text_col, F.lit(""))), F.lit(self.vocabulary))
        held = F.explode_outer(F.when(F.size(seen) > 0, seen)).alias("term")
        heard = stored(files.select(held).groupBy("term").agg(F.count("*").alias("n")), "heard")
        idf = lambda df: F.log((F.lit(1.0) + self.n) / (F.lit(1.0) + df)) + 1
        self.n, licences = files.count(), self.templates.select("license").distinct().count()
        rarity = lambda df: F.log(F.lit(1.0 + licences) / (F.lit(1.0) + df)) + 1
        self.other = idf(F.lit(1)) * rarity(F.lit(0))
        spread = counted.groupBy("term").agg(F.count_distinct("license").alias("licences")).join(heard, "term", "left")
        self.idf = stored(spread.select("term", (idf(F.coalesce("n", F.lit(0))) * rarity(F.col("licences"))).alias("idf")), "idf")
        own = W.partitionBy("template")
        full = self.templates.select("template", (F.size("terms") > WINDOWED).alias("full"))
        words = counted.join(full, "template").join(self.idf, "term").withColumn("w", F.col("tf") * F.col("idf"))
        words = words.withColumn("norm", F.sqrt(F.sum(F.col("w") * F.col("w")).over(own)))
        tail = F.sqrt(F.sum(F.col("w") * F.col("w")).over(own.orderBy("w", "term").rowsBetween(W.unboundedPreceding, 0)))
        self.words = stored(words.withColumn("anchor", tail >= F.col("norm") * (least - 1e-9)), "vectors")
        self.anchors = [r["term"] for r in self.words.where("anchor").select("term").distinct().orderBy("term").collect()]

    def places(self) -> DataFrame:
        """(anchor, at, n, shares): where a template of n words, at most WINDOWED, has an anchor, and the share of its
        squared norm that each of its words holds."""
        shares = self.words.groupBy("template").agg(F.collect_list(F.struct("term", (F.col("w") * F.col("w") / (F.col("norm") * F.col("norm"))).alias("share"))).alias("shares"))
        laid = self.templates.where(F.size("terms") <= WINDOWED).select("template", F.size("terms").alias("n"), F.posexplode("terms").alias("at", "anchor"))
        anchors = self.words.where("anchor").select("template", F.col("term").alias("anchor")).distinct()
        return stored(laid.join(anchors, ["template", "anchor"]).join(shares, "template").select("anchor", "at", "n", "shares").distinct(), "places")


def units_of(files: DataFrame, vectors: Vectors, path_col: str, text_col: str, least: float) -> DataFrame:
    """(key, path, uid, unit): what is compared of each text that holds an anchor, as words joined by blanks, and its digest."""
    anchors, some = F.lit(vectors.anchors).cast("array<string>"), lambda words: F.arrays_overlap(words, F.lit(vectors.anchors).cast("array<string>"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    told = files.select(key_of(F.col(path_col), F.col(text_col)).alias("key"), F.col(path_col).alias("path"), text.alias("text"), terms(text).alias("words")).where(F.arrays_overlap("words", anchors))
    blocks = told.select("key", "path", F.explode(F.concat(
        F.transform(F.concat(F.array("text"), F.split("text", r"\n[ \t]*\r?\n")), lambda x: F.struct(F.lit(True).alias("block"), x.alias("text"))),
        F.transform(F.split("text", "\n"), lambda x: F.struct(F.lit(False).alias("block"), x.alias("text"))),
    )).alias("u")).select("key", "path", "u.block", terms(F.col("u.text")).alias("words")).where(some(F.col("words")))
    known = F.size(F.filter("words", lambda w: w.isin(vectors.vocabulary)))
    blocks = blocks.where(~F.col("block") | (2 * known >= F.size("words"))).select("key", "path", F.array_join("words", " ").alias("unit"))
    # Windows: only the words about an anchor go on.
    reach = WINDOWED - 1
    start = F.greatest(F.col("pos") - reach, F.lit(0))
    hits = told.select("key", "path", "words", F.posexplode("words").alias("pos", "anchor")).where(F.col("anchor").isin(vectors.anchors))
    hits = hits.select("key", "path", "anchor", (F.col("pos") - start).alias("pos"), F.slice("words", start + 1, F.lit(2 * WINDOWED)).alias("words"))
    first = F.greatest(F.col("pos") - F.col("at"), F.lit(0))
    laid = hits.join(small(vectors.places()), "anchor").select("key", "path", "shares", F.slice("words", first + 1, F.col("n")).alias("words"))
    share = F.aggregate(F.filter("shares", lambda x: F.array_contains(F.col("words"), x["term"])), F.lit(0.0), lambda a, x: a + x["share"])
    laid = laid.where(share >= least * least - 1e-9).select("key", "path", F.array_join("words", " ").alias("unit"))
    return stored(blocks.union(laid).distinct().withColumn("uid", F.md5("unit")), "units")


def scored_units(units: DataFrame, vectors: Vectors, least: float) -> DataFrame:
    """(uid, license, full, score): the licences that a unit meets, by a whole licence or a notice, with 4 decimals.
    Units move once, whole, to the task that counts, weighs and compares their words."""
    once = units.groupBy("uid").agg(F.first("unit").alias("unit"))
    counted = once.select("uid", F.explode(F.split("unit", " ")).alias("term")).groupBy("uid", "term").agg(F.count("*").alias("tf"))
    weighed = counted.join(small(vectors.idf), "term", "left").select("uid", "term", (F.col("tf") * F.coalesce("idf", vectors.other)).alias("w"))
    normed = weighed.withColumn("unit_norm", F.sqrt(F.sum(F.col("w") * F.col("w")).over(W.partitionBy("uid"))))
    dots = normed.alias("u").join(small(vectors.words).alias("t"), "term").groupBy("uid", "unit_norm", "license", "full", "template", "norm").agg(F.sum(F.col("u.w") * F.col("t.w")).alias("dot"))
    scored = dots.select("uid", "license", "full", F.round(F.col("dot") / (F.col("norm") * F.col("unit_norm")), 4).alias("score"))
    return scored.where(F.col("score") >= least).groupBy("uid", "license", "full").agg(F.max("score").alias("score"))


def owned_licences(units: DataFrame, scored: DataFrame) -> DataFrame:
    """(key, path, license, score): each file's own licence."""
    best = F.min(F.struct((~F.col("full")).alias("notice"), (-F.col("score")).alias("s"), "license")).alias("b")
    return stored(units.select("key", "path", "uid").join(small(scored), "uid").groupBy("key", "path").agg(best).select("key", "path", "b.license", (-F.col("b.s")).alias("score")), "owned")


def nearest_folders(files: DataFrame, owned: DataFrame, path_col: str) -> DataFrame:
    """(__own, g): for each folder with files the nearest above it, or itself, that has a licence file with a licence."""
    given = owned.where(F.col("path").rlike(LICENSE_FILE)).withColumn("folder", folder_of(F.col("path")))
    given = given.groupBy("folder").agg(F.min(F.struct((-F.col("score")).alias("s"), "license")).alias("b")).select("folder", "b.license", (-F.col("b.s")).alias("score"))
    given = stored(given.withColumn("depth", F.size(F.split("folder", "/"))), "folders")
    deepest = given.agg(F.max("depth")).first()[0] or 0
    folders = files.select(folder_of(F.col(path_col)).alias("own")).distinct().where("own is not null").withColumn("p", F.split("own", "/"))
    above = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(F.size("p"), F.lit(deepest)))), lambda k: F.array_join(F.slice("p", 1, k), "/"))
    above = F.when(F.col("own") == "", F.array(F.lit(""))).otherwise(F.array_union(F.array(F.lit("")), above))
    chain = folders.select("own", F.explode(above).alias("folder")).join(small(given.drop("depth")), "folder")
    nearest = chain.groupBy("own").agg(F.max(F.struct(F.char_length("folder").alias("l"), "folder", "license", "score")).alias("g"))
    return stored(nearest.select(F.col("own").alias("__own"), "g"), "nearest")


def scan(files: DataFrame, templates: DataFrame | None = None, path_col: str = "path", text_col: str = "text", least: float = LEAST) -> DataFrame:
    """``files`` with license, score (4 decimals), origin (own, inherited or none) and folder (that it inherits from)."""
    spark = files.sparkSession
    files = files.drop(*(c for c in OUTPUTS if c not in (path_col, text_col)))
    if templates is None:
        templates = spark.createDataFrame(TEMPLATES, "license string, text string")
    vectors = Vectors(files, text_col, templates, least)
    units = units_of(files, vectors, path_col, text_col, least)
    owned = owned_licences(units, stored(scored_units(units, vectors, least), "scored"))
    nearest = nearest_folders(files, owned, path_col)
    out = files.withColumns({"__key": key_of(F.col(path_col), F.col(text_col)), "__own": folder_of(F.col(path_col))})
    out = out.join(small(owned.select(F.col("key").alias("__key"), F.col("license").alias("__l"), F.col("score").alias("__s"))), "__key", "left").join(small(nearest), "__own", "left")
    direct = F.col("__l").isNotNull()
    return out.withColumns({
        "license": F.coalesce("__l", "g.license"),
        "score": F.coalesce("__s", "g.score"),
        "origin": F.when(direct, "own").when(F.col("g").isNotNull(), "inherited").otherwise("none"),
        "folder": F.when(~direct, F.col("g.folder")),
    }).drop("__key", "__own", "__l", "__s", "g")
