import random
from fractions import Fraction

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sluice.llm import mixing, multi_index, simhash
from sluice.llm.graph import connected_components


def find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def union(parent, x, y):
    x, y = find(parent, x), find(parent, y)
    parent[max(x, y)] = min(x, y)


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 130)] + [(rng.randint(200, 300), rng.randint(200, 300)) for _ in range(60)] + [(7, 7)]
    parent = {v: v for e in edges for v in e}
    for a, b in edges:
        union(parent, a, b)
    got = {r.v: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {v: find(parent, v) for v in parent if any(v in e and e[0] != e[1] for e in edges)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_fingerprint(text, size=3):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_matches_brute_force(spark):
    rng = random.Random(4)
    base = [" ".join(rng.choices(["aa", "Bb", "c", "dd", "É"], k=80)) for _ in range(8)]
    texts = [None, "", "one", "one two", "A b", "a B"] + base + [b + " x" for b in base] + [b.replace("aa", "AA") for b in base] + ["w " * 40000]
    rows = [(i, t, "f") for i, t in enumerate(texts)] + [(3, "one two", "again"), (None, "one two", None)]
    got = simhash.simhash_components(spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")).collect()
    assert len(got) == len(rows)
    fps = [brute_fingerprint(t) for _, t, _ in rows]
    parent = {i: i for i in range(len(rows))}
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                union(parent, i, j)
    least = {}
    for i, (doc, _, _) in enumerate(rows):
        if doc is not None:
            least[find(parent, i)] = min(doc, least.get(find(parent, i), doc))
    want = sorted((str(d), f"{fps[i]:016x}", least[find(parent, i)]) for i, (d, _, _) in enumerate(rows))
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got) == want
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.simhash_components(empty).count() == 0 and simhash.near_copies(empty).count() == 0


@pytest.mark.parametrize("distance, limit", [(2, 20000), (2, 3), (3, 5), (1, 2)])
def test_links_of_hot_variants(spark, distance, limit):
    rng, fps = random.Random(5), set()
    for _ in range(4):
        centre = rng.getrandbits(64)
        for _ in range(40):
            x = centre
            for b in rng.sample(range(64), rng.randint(0, 4)):
                x ^= 1 << b
            fps.add(simhash._long(x))
    fps = sorted(fps)
    parent = {x: x for x in fps}
    for i, x in enumerate(fps):
        for y in fps[:i]:
            if ((x ^ y) & (1 << 64) - 1).bit_count() <= distance:
                union(parent, x, y)
    nodes = spark.createDataFrame([(x, x) for x in fps], "node long, fp long")
    got = {r.v: r.root for r in connected_components(simhash.candidate_links(nodes, distance, limit)).collect()}
    assert {x: got.get(x, x) for x in fps} == {x: find(parent, x) for x in fps}


def edited(rng, words, n):
    """The words with n of them replaced, spread."""
    out = list(words)
    for i in rng.sample(range(2, len(words) - 2, 6), n):
        out[i] = str(rng.random())
    return out


@pytest.mark.parametrize("limits", [{}, {"limit": 3, "text_limit": 20_000}])
def test_near_copies_match_brute_force(spark, limits):
    """Pairs on both sides of 0.8, of distinct and of frequent words, and groups of many near copies of one text."""
    rng, rows = random.Random(12), []
    for g in range(40):
        words = [str(rng.randint(0, 10**6)) for _ in range(304)] if g % 2 else rng.choices("a b c d e f g h i j".split(), k=304)
        rows += [words, edited(rng, words, rng.choice([4, 5, 6, 7, 8]))]
    for _ in range(3):
        words = [str(rng.randint(0, 10**6)) for _ in range(204)]
        rows += [edited(rng, words, rng.randint(0, 7)) for _ in range(15)]
    rows += ["a b c d e f g h i".split(), "a b c d e f g h i j".split(), "x".split(), "x y".split()]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in rows]
    parent = {i: i for i in range(len(rows))}
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 5 * both >= 4 * len(sets[i] | sets[j]):
                union(parent, i, j)
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.near_copies(frame, **limits).collect()}
    assert got == {i: find(parent, i) for i in parent}


def test_near_copies(spark):
    rng = random.Random(6)
    text = lambda n: [str(rng.randint(0, 10**6)) for _ in range(n)]
    rows, groups = [], []
    for g in range(12):
        words = text(300)
        near = words[:150] + ["edit"] + words[151:]
        rows += [(3 * g, " ".join(words)), (3 * g + 1, " ".join(near)), (3 * g + 2, " ".join(text(300)))]
        groups.append({3 * g, 3 * g + 1})
    rows += [(100, rows[0][1]), (101, None), (102, ""), (103, "a b"), (104, "b a")]
    got = {r.doc_id: r.component_id for r in simhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    caught = sum(got[max(g)] == min(g) for g in groups)
    assert caught >= 11 and got[100] == 0 and got[102] == got[101]
    assert all(got[3 * g + 2] == 3 * g + 2 for g in range(12)) and got[104] == 104


def test_near_copies_by_fingerprints(spark):
    """Short texts, whose shingles may all lie outside the min-hash bands, or differ in each band that they are in."""
    rows = [(2 * i + j, t) for i in range(200) for j, t in enumerate((f"w{i} x y", f"W{i}  x y"))]
    cycle = "mcm bqo zph wxu yvr " * 30
    rows += [(400, cycle), (401, cycle + "more")]
    hashes = [simhash.shingle_hashes(t.encode(), 5) for _, t in rows]
    bands = [set(simhash.bands(*simhash.least_hashes(h))) for h in hashes]
    assert not bands[400] & bands[401] and sum(not b for b in bands) > 2
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.near_copies(frame).collect()}
    assert got == {i: i // 2 * 2 for i, _ in rows}


def test_fingerprint_links_match_brute_force(spark):
    rng, rows = random.Random(8), []
    for node in range(120):
        near = rows and rng.random() < 0.6
        fp = rng.choice(rows)[1] if near else simhash._long(rng.getrandbits(64))
        for b in rng.sample(range(63), rng.randint(0, 4) if near else 0):
            fp ^= 1 << b
        rows.append((node, fp))
    parent = {n: n for n, _ in rows}
    for x, a in rows:
        for y, b in rows[:x]:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2:
                union(parent, x, y)
    links = simhash.fingerprint_links(spark.createDataFrame(rows, "node long, fp long"), 2, 20000)
    got = {r.v: r.root for r in connected_components(links).collect()}
    assert {n: got.get(n, n) for n in parent} == {n: find(parent, n) for n in parent}


def brute_targets(sizes, weights=(1, 2, 3)):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, fixed = Fraction(sum(sizes.values())), {}
    while True:
        free = [s for s in order if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return {**share, **fixed}
        fixed |= {s: Fraction(3 * sizes[s]) for s in over}


def test_mix(spark):
    rng, rows = random.Random(7), []
    for source, n in (("b", 120), ("a", 40), (None, 30), ("é", 3), ("zero", 2), ("Z", 200)):
        first = len(rows)
        rows += [(first + k, None if source == "zero" else " ".join(["w"] * rng.randint(0, 40)), source, 5) for k in range(n)]
    rows += [(1000 + i, "same " * 7, "Z", 5) for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, taken int")
    got = mixing.mix_sources(frame).collect()
    again = mixing.mix_sources(frame.repartition(5)).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)
    sizes = {}
    for _, t, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want, taken = brute_targets(sizes), {}
    for r in got:
        assert r.size == len((r.text or "").split()) and r.taken in (0, r.size, 2 * r.size, 3 * r.size)
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(float(want[r.source]), rel=1e-12)
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(abs(taken[s] - float(want[s])) <= 1.001 for s in taken)
    assert mixing.mix_sources(frame.limit(0)).count() == 0


def test_budgets():
    rng = random.Random(8)
    for _ in range(200):
        lengths = rng.sample(range(1, 60), rng.randint(1, 8))
        counts = [rng.randint(1, 5) for _ in lengths]
        budget = rng.randint(0, sum(n * c for n, c in zip(lengths, counts, strict=True)))
        take = mixing.fit_budget(lengths, counts, budget)
        reach = {0}
        for n, c in zip(lengths, counts, strict=True):
            reach = {r + n * k for r in reach for k in range(c + 1)}
        assert all(0 <= t <= c for t, c in zip(take, counts, strict=True))
        assert sum(t * n for t, n in zip(take, lengths, strict=True)) == max(r for r in reach if r <= budget)


def test_budgets_of_any_lengths():
    """Against the best sum that can be reached, by a bitset."""
    rng = random.Random(11)
    for _ in range(300):
        lengths = rng.sample(range(20_000, 90_000), 6)
        counts = [rng.randint(1, 4) for _ in lengths]
        budget = rng.randint(0, sum(n * c for n, c in zip(lengths, counts, strict=True)))
        reach = 1
        for n, c in zip(lengths, counts, strict=True):
            for _ in range(c):
                reach |= reach << n
        take = mixing.fit_budget(lengths, counts, budget)
        assert all(0 <= t <= c for t, c in zip(take, counts, strict=True))
        assert sum(t * n for t, n in zip(take, lengths, strict=True)) == (reach & (1 << budget + 1) - 1).bit_length() - 1
    for _ in range(40):  # sums beyond the window
        lengths = rng.sample(range(100, 900), 30)
        counts = [rng.randint(50, 400) for _ in lengths]
        budget = rng.randint(0, sum(n * c for n, c in zip(lengths, counts, strict=True)))
        take = mixing.fit_budget(lengths, counts, budget, whole=5000)
        assert all(0 <= t <= c for t, c in zip(take, counts, strict=True))
        assert budget - 100 < sum(t * n for t, n in zip(take, lengths, strict=True)) <= budget


def test_mix_of_rows_that_are_hard_to_tell_apart(spark):
    """Null ids, ids that repeat, and equal rows: each source comes within a document of its target."""
    rows = [(None, "w " * (k % 7 + 1), "a") for k in range(90)] + [(5, "x " * (k % 5 + 1), "b") for k in range(70)] + [(None, "same " * 4, "c")] * 130 + [(1, "same " * 4, "d")] * 50
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = mixing.mix_sources(frame).collect()
    sizes, taken = {}, {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    want = brute_targets(sizes)
    assert len(got) == len(rows) and all(r.taken <= 3 * r.size for r in got)
    assert all(0 <= float(want[s]) - taken[s] + 0.5 <= 5 for s in sizes)


def test_running_sums(spark):
    from sluice.llm.common import running

    rng = random.Random(2)
    rows = [(k, rng.randint(0, 9)) for k in range(500)]
    frame = spark.createDataFrame(rows, "k long, n long").repartition(3)
    got = {r.k: (r["rank"], r.s) for r in running(frame, [F.col("k").desc()], s="n").collect()}
    assert got == {k: (500 - k, sum(n for j, n in rows if j > k)) for k, _ in rows}
    assert running(frame.limit(0), [F.col("k")], s="n").count() == 0


def test_budgets_of_long_documents():
    """Lengths above SPAN, and more distinct ones than SHORTEST."""
    taken = lambda lengths, counts, budget: sum(t * n for t, n in zip(mixing.fit_budget(lengths, counts, budget), lengths, strict=True))
    assert taken([1000, 200_000], [100, 1], 250_000) == 250_000
    assert taken([1000, 9_000_000], [8000, 1], 9_500_000) == 9_500_000
    assert taken([1000 * k for k in range(1, 61)] + [3_000_001], [2] * 60 + [1], 3_100_001) == 3_100_001
    rng = random.Random(10)
    for _ in range(30):
        lengths = rng.sample(range(500, 150_000, 500), rng.randint(2, 6))
        counts = [rng.randint(1, 3) for _ in lengths]
        budget = rng.randint(0, sum(n * c for n, c in zip(lengths, counts, strict=True)))
        reach = {0}
        for n, c in zip(lengths, counts, strict=True):
            reach = {r + n * k for r in reach for k in range(c + 1)}
        take = mixing.fit_budget(lengths, counts, budget)
        assert all(0 <= t <= c for t, c in zip(take, counts, strict=True))
        assert sum(t * n for t, n in zip(take, lengths, strict=True)) == max(r for r in reach if r <= budget)


def test_nearest_matches_brute_force(spark):
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(20, 8)) * 4
    x = (centres[rng.integers(0, 20, 3000)] + rng.normal(size=(3000, 8))).astype(np.float32)
    x[50:400] = x[50]  # many copies
    rows = [(i, v.tolist(), "e") for i, v in enumerate(x)]
    odd = [(5000, None, "x"), (5001, [0.0] * 8, "x"), (5002, [1.0, None] + [0.0] * 6, "x"), (5003, [float("nan")] * 8, "x"), (5004, [float("inf")] * 8, "x"), (5005, [1.0], "x"), (None, x[0].tolist(), "x")]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, score string")
    got = multi_index.nearest(frame, frame.where("vec_id % 100 = 0"), 10).collect()
    found, hits = {}, 0
    for r in got:
        found.setdefault(r.query_id, []).append((r["rank"], r.id, r.score))
    d = x.astype(float)
    for q in range(0, 3000, 100):
        exact = np.sqrt(((d - d[q]) ** 2).sum(1))
        exact[q] = np.inf
        order = np.lexsort((np.arange(3000), exact))[:10]
        mine = sorted(found[q])
        assert [m[0] for m in mine] == list(range(1, 11))
        assert all(m[2] == pytest.approx(exact[m[1]], abs=1e-12) for m in mine)
        assert [(m[2], m[1]) for m in mine] == sorted((m[2], m[1]) for m in mine)
        hits += len(set(order) & {m[1] for m in mine})
    assert hits / 300 >= 0.9 and len(found) == 30
    few = frame.where("vec_id in (0, 100, 5001)")
    assert [(r.query_id, r.id) for r in multi_index.nearest(few, few, 10).orderBy("query_id").collect()] == [(0, 100), (100, 0)]
    assert multi_index.nearest(frame.limit(0), frame.limit(0)).count() == 0


def test_few_candidates_where_vectors_are_clustered(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(200, 16)) * 4
    x = (centres[rng.integers(0, 200, 20_000)] + rng.normal(size=(20_000, 16))).astype(np.float32)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    index = multi_index.Index(frame, 10, None, 0.97, "vec_id", "embedding", multi_index.SAMPLE, multi_index.PROBES)
    assert index.candidates < 0.1 * index.counts.sum() == 2000
    found, hits, d = {}, 0, x.astype(float)
    for r in multi_index.search(index, frame.where("vec_id % 100 = 0"), 10).collect():
        found.setdefault(r.query_id, set()).add(r.id)
    for q in range(0, 20_000, 100):
        exact = ((d - d[q]) ** 2).sum(1)
        exact[q] = np.inf
        hits += len(found[q] & set(np.argsort(exact)[:10].tolist()))
    assert hits / 2000 >= 0.9
