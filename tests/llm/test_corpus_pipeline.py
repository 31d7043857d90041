"""Each stage of the pipeline against a brute-force version, on its own input."""

import random

import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from sluice.llm import language_id, queries, sentence_pieces
from tests.llm.test_groups_and_mixes import brute_targets, find, union
from tests.llm.test_texts import brute_cut

#: Copied with a word more.
NEAR = (3, 7, 11, 22, 34, 41, 48, 53)
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Columns named like ones that the operators make.
CLASHING = ["size", "taken", "copies", "copy", "target", "score", "held_out", "lang_pred", "kept", "removed", "key", "component_id", "__hash", "__key"]


@pytest.fixture(scope="module")
def docs(spark):
    rng, rows = random.Random(1), []
    words = {"en": ["the", "and", "with", "that", "thing", "over"], "fr": ["que", "les", "été", "pour", "ça", "au"]}
    passage = " ".join(str(rng.randint(0, 10**6)) for _ in range(20))
    for i in range(60):
        lang = ("en", "fr")[i % 2]
        text = " ".join(rng.choice(words[lang]) + str(rng.randint(0, 99)) for _ in range(rng.randint(30, 120)))
        rows.append((i, text + (" " + passage if i % 5 == 0 else ""), lang, f"s{i % 4}", len(text)))
    rows += [(100, rows[0][1], "en", "s0", 1), (101, rows[3][1], "fr", None, 1)]
    rows += [(200 + i, rows[i][1] + " end", "fr", None, 1) for i in NEAR]  # near copies
    rows += [(102, None, "en", "s1", None), (103, "12 34", "en", "s1", 5), (104, "", "en", "s1", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def recognised(spark, rows):
    """Ids of the documents that the network recognises, one text at a time."""
    net, names = language_id.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), "doc_id", "text", "lang")
    lettered = [r for r in rows if r.text and any(c.isalpha() for c in r.text)]
    return {r.doc_id for r in lettered if language_id.pooled(net, [r.text.encode()])[0].max() >= corpus_pipeline.LEAST_SCORE}


def firsts(rows):
    """Ids of the first document of each group of texts whose five-word shingles agree to 0.8."""
    words = [(r.text or "").lower().split() for r in rows]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in words]
    parent = {r.doc_id: r.doc_id for r in rows}
    for i, x in enumerate(rows):
        for j, y in enumerate(rows[:i]):
            if (x.text or "") == (y.text or "") or sets[i] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                union(parent, x.doc_id, y.doc_id)
    return {d for d in parent if find(parent, d) == d}


def test_stages(spark, docs):
    last = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, last, None).cache()
        rows, old = out.collect(), {r.doc_id: r for r in last.collect()}
        ids = {r.doc_id for r in rows}
        if name == "language ID":
            assert ids == recognised(spark, list(old.values())) and not ids & {102, 103, 104} and len(rows) == len(ids)
        elif name == "SimHash near-dedup":
            assert ids == firsts(list(old.values())) and len(rows) == len(ids)
            assert not ids & ({200 + i for i in NEAR} | {100, 101})
        elif name == "suffix-array dedup":
            want = {i: n for i, n, _, _ in brute_cut([(r.doc_id, r.text) for r in old.values()])}
            assert {r.doc_id: len(old[r.doc_id].text.encode()) - len(r.text.encode()) for r in rows} == want
            assert sum(want.values()) > 0 and all(r.n_chars == (len(r.text) if want[r.doc_id] else old[r.doc_id].n_chars) for r in rows)
        elif name == "mixing":
            sizes, taken, times = {}, {}, {}
            for r in old.values():
                sizes[r.source] = sizes.get(r.source, 0) + len(r.text.split())
            for r in rows:
                assert r == old[r.doc_id]
                taken[r.source] = taken.get(r.source, 0) + len(r.text.split())
                times[r.doc_id] = times.get(r.doc_id, 0) + 1
            want = brute_targets(sizes)
            assert max(times.values()) <= 3 and all(abs(float(want[s]) - taken[s]) <= 120 for s in sizes)  # a document's words
        else:
            library = sentencepiece.SentencePieceProcessor(model_file=sentence_pieces.MODEL)
            assert all(r.lossless and r.token_ids == library.encode(old[r.doc_id].text) for r in rows) and len(rows) == last.count()
        if name != "SentencePiece":
            assert out.columns == COLUMNS
        last = out


def test_clashing_columns_and_rows_without_id(spark, docs):
    wide = docs.unionByName(docs.where("doc_id = 5").withColumn("doc_id", F.lit(None).cast("long")))
    for k, c in enumerate(CLASHING):
        wide = wide.withColumn(c, F.concat(F.lit(f"{k}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    last = wide
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, last, None).cache()
        assert out.columns == COLUMNS + CLASHING, name
        for r in out.collect():
            assert [r[c] for c in CLASHING] == [f"{k}:{'none' if r.doc_id is None else r.doc_id}" for k in range(len(CLASHING))], name
        last = out
    coded = corpus_pipeline.STAGES[-1][1](spark, last, None)
    assert set(CLASHING) <= set(coded.columns) and coded.count() == last.count() > 0


def test_empty_tables(spark, docs):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), None).count() == 0, name


def test_names():
    assert {int(q.split("_")[0][2:]) for q in queries.QUERIES} == set(range(1, 11))
    assert [s[0] for s in corpus_pipeline.STAGES] == ["language ID", "SimHash near-dedup", "suffix-array dedup", "mixing", "SentencePiece"]
