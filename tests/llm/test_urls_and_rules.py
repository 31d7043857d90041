import random

import pytest

from sluice.llm import quality_rules, url_filter

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"), ("b.c", "/x", "block"), ("a.b.c", "", "allow"), ("c", "/x/y/z", "block"), ("c", "/x/y/z", "allow")]


def brute(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:] if rest[cut : cut + 1] == "/" else ""
        path = path[: min([path.find(c) for c in "?#" if c in path] + [len(path)])]
    fits = [(len(h) + len(p), len(h), h + p, a) for h, p, a in RULES if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def test_urls_match_brute_force(spark):
    rng = random.Random(2)
    urls = [None, "", "no scheme", "http://", "HTTP://Example.NET/en/x?y#z", "a://b://c/", "http://x.net", "http://x.net?/en/", "x://a.b.c/x/y/z/w", "x://É.net/É", "x://" + "a." * 3000 + "net/" + "p/" * 3000, "x://a\n.net/\nq"]
    urls += ["http://" + ".".join(rng.choices(["a", "b", "c", "net", "example", "org", "NET"], k=rng.randint(1, 4))) + rng.choice(["", "/", "/en/", "/x/y/z", "/x/y/", "/fr/q?x", "/xy", "#/"]) for _ in range(300)]
    rows = [(i, u, "old") for i, u in enumerate(urls)] + [(0, urls[5], "again"), (None, "http://q.net/", None)]
    rules = spark.createDataFrame(RULES + [(None, "/", "block")], "host string, path string, action string")
    got = url_filter.filter_urls(spark.createDataFrame(rows, "page_id long, url string, verdict string"), rules).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == brute(r.url)


def test_urls_without_rows_or_rules(spark):
    rules = spark.createDataFrame([], "host string, path string, action string")
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    assert [tuple(r) for r in url_filter.filter_urls(pages, rules).select("rule", "verdict").collect()] == [(None, "allow")]
    assert url_filter.filter_urls(pages.limit(0), spark.createDataFrame(RULES, "host string, path string, action string")).count() == 0


def brute_counts(text):
    words = (text or "").encode().split()
    words = [w.decode() for w in words]
    grams = {}
    for i in range(len(words) - 4):
        grams.setdefault(tuple(words[i : i + 5]), []).append(i)
    covered = {i + j for at in grams.values() if len(at) > 1 for i in at for j in range(5)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_quality_counts_match_brute_force(spark):
    rng = random.Random(3)
    texts = [None, "", " \n\t", "a b c d e a b c d e", "x " * 50, "é\u00a0ü #$% | <b>\nq\nq\n\nq", "a b c d e f\x0bg\x0ch\ri j", "w " * 3000 + "\n" * 100]
    texts += [" ".join(rng.choices("ab", k=rng.randint(0, 60))) + rng.choice(["", "\nx y\nx y"]) for _ in range(100)]
    docs = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, n_words int")
    got = quality_rules.apply_quality_rules(docs).orderBy("doc_id").collect()
    for r, t in zip(got, texts, strict=True):
        want = brute_counts(t)
        assert tuple(r[c] for c in quality_rules.COUNTS) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
    assert quality_rules.apply_quality_rules(docs.limit(0)).count() == 0


@pytest.mark.parametrize("text, kept", [
    ("The cat of the house and the dog went to see that it is in the garden with her.", True),
    ("WORD!! SHOUT!! LOUD!! MORE!! THINGS!! ARE!! HERE!! NOW!! AND!! THEN!! SOME!!", False),
    ("a%% b## c$$ d&& e** f%% g## h$$ i&& j** k%% l##", False),
])
def test_quality_verdicts(spark, text, kept):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert quality_rules.apply_quality_rules(docs).first().kept is kept


def test_rules_are_native(spark):
    plan = quality_rules.apply_quality_rules(spark.createDataFrame([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
