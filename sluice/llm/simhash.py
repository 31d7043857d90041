"""SimHash near-duplicates through deletion-variant signatures.

A fingerprint has a bit set where over half of a text's word shingles (repeats included) have it set in their
XXH64. To link fingerprints at ``distance`` bits or fewer, the 64 bits are cut into so few segments that two linked
ones have a segment that differs by at most one bit: (distance + 2) // 2. Each segment is indexed whole and with one
bit left out; an equality join on these variants gives the candidates, which are verified on all bits.

The fingerprints of one variant are gone through by a breadth-first search that emits a spanning forest of their links,
so the edges stay linear. Hot variants, which more than ``limit`` fingerprints share, don't go to one task: their
remaining bits are indexed with all the wildcards that the distance still allows; fingerprints that share such a key
are all within the distance, so each is linked to the key's smallest. No link between components is lost.

near_copies() links texts by the Jaccard similarity of their sets of five-word shingles (64-bit hashes), decided on
the shingles themselves. Candidates are first the texts whose fingerprints the search above links. Fingerprints of texts
of similarity 0.8 are about ten bits apart, which no index of variants reaches; such pairs are added where they agree in
one of BANDS bands of a one-permutation min-hash, whichever words they have, and to ``LOOSE`` in the whole sketch; a
pair of similarity 0.8 misses all bands once in ten thousand times, one of few shingles more often.
Candidates only say which texts meet: in each component of candidates all pairs are searched for exact links, so that
no pair hangs on a third text. Keys and components too large for one task are dealt into blocks, and each pair of blocks is searched.

Defined cases: null and empty texts have fingerprint zero and are linked like any other; fewer words than a shingle
make one shingle of all; repeated rows share a component and each get a row; null ids are never a component's id
unless it has no other; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from functools import partial
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import few_rows, lean, slices, small, stored
from sluice.llm.graph import connected_components

SEED = 42
BLOCK = 1 << 15
#: Fingerprints of one variant that go to one task.
LIMIT = 20_000
#: Rows that a Python task reads as one table.
TASK_ROWS = 250_000


def shingles(words: list[bytes], size: int):
    """Iterator over the space-joined shingles; the whole sequence if it is shorter than one."""
    if len(words) <= size:
        return iter([b" ".join(words)] if words else [])
    return map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))


def fingerprint(text: bytes | None, size: int) -> int:
    words = (text or b"").lower().split()  # both act on ASCII only
    n = max(1, len(words) - size + 1) if words else 0
    if not n:
        return 0
    return majority(np.fromiter(map(xxhash.xxh64_intdigest, shingles(words, size), repeat(SEED)), np.uint64, n))


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    n, ones = len(hashes), np.zeros(64, np.int64)
    for k in range(0, n, BLOCK):
        part = hashes[k : k + BLOCK]
        ones += np.add.reduce(np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"), axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


@lean
def _fingerprints(size: int, batches):
    for batch in slices(batches):
        found = [fingerprint(t, size) for t in batch.column(1).cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(found, np.uint64).view(np.int64))], ["id", "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp): fp is the fingerprint as a signed long."""
    few_rows(docs.sparkSession)
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(partial(_fingerprints, shingle), "id long, fp long")


def masks(segments: int) -> list[tuple[int, int]]:
    """(mask of a segment, mask of the bit left out or 0) of each variant."""
    edges = [64 * i // segments for i in range(segments + 1)]
    whole = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(edges, edges[1:], strict=False)]
    return [(m, w) for m in whole for w in [0, *(1 << b for b in range(64) if m >> b & 1)]]


def _long(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def similar(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of sketch a to each row of b."""
    return ((b == a) & (a > 0)).sum(-1) / np.maximum(1, ((b > 0) | (a > 0)).sum(-1))


def _groups(whole, batches):
    """All rows of a partition as a table ordered by variant, and the (first, end) of each variant worth a look: two
    rows or more and, where a bit is left out, both of its values; else the rows share the whole segment too."""
    table = pa.Table.from_batches(batches)
    kind, part = table["kind"].to_numpy(), table["part"].to_numpy()
    order = np.lexsort((part, kind >> 1))
    kind, part = kind[order], part[order]
    cuts = np.flatnonzero((kind[1:] >> 1 != kind[:-1] >> 1) | (part[1:] != part[:-1])) + 1
    lo, hi = np.r_[0, cuts], np.r_[cuts, len(kind)]
    bit = kind & 1
    ones = np.add.reduceat(bit, lo) if len(kind) else lo[:0]
    entire = np.array(whole)[kind[lo] >> 1] if len(kind) else np.zeros(0, bool)
    worth = (hi - lo > 1) & (entire | (ones > 0) & (ones < hi - lo)) if len(kind) else np.zeros(0, bool)
    return table, order, lo[: len(worth)][worth], hi[: len(worth)][worth]


def _spanned(node: np.ndarray, groups, near) -> pa.RecordBatch:
    """Edges of a spanning forest of each group's links, found breadth first; near(x, left) says which of ``left`` are linked to x."""
    a, b = [], []
    for left in groups:
        while len(left) > 1:
            todo, left = [left[0]], left[1:]
            while todo and len(left):
                x = todo.pop()
                linked = near(x, left)
                if linked.any():
                    got = left[linked]
                    a.append(np.full(len(got), node[x]))
                    b.append(node[got])
                    todo += got.tolist()
                    left = left[~linked]
    out = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b)]
    return pa.RecordBatch.from_arrays([pa.array(out[0]), pa.array(out[1])], ["a", "b"])


@lean
def _forest(whole, distance, batches):
    """A partition of variants -> edges of a spanning forest of each variant's links."""
    if not (batches := list(batches)):
        return
    table, order, firsts, ends = _groups(whole, batches)
    node = table["node"].to_numpy()[order]
    fp = node.view(np.uint64)
    groups = (np.arange(lo, hi) for lo, hi in zip(firsts, ends, strict=True))
    yield _spanned(node, groups, lambda x, left: np.bitwise_count(fp[left] ^ fp[x]) <= distance)


def paired(rows: DataFrame, keys: list[str], blocks: Column) -> DataFrame:
    """``rows`` of too large groups (``keys``), dealt into ``blocks`` (3 or more) by node, once for each pair of blocks of a
    group. Any two rows of a group share a ``part``, the long that stands for a group's pair of blocks."""
    mine = rows.withColumn("__n", blocks.cast("long")).withColumn("__b", F.pmod(F.xxhash64("node", F.lit(SEED)), F.col("__n")))
    each = mine.withColumn("__o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1))).where("__o <> __b")
    return each.withColumn("part", F.xxhash64(*keys, F.least("__b", "__o"), F.greatest("__b", "__o"))).drop("__n", "__b", "__o")


def enough(rows: DataFrame, times: int = 1) -> int:
    """Partitions that hold at most about ``TASK_ROWS`` of the rows, or twice the session's number."""
    least = 2 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-rows.count() * times // TASK_ROWS))


def candidate_links(nodes: DataFrame, distance: int = 2, limit: int = LIMIT) -> DataFrame:
    """Edges (a, b) between ``nodes`` (node, fp; node is fp), whose components are those of all links."""
    if not 0 <= distance <= 3:
        raise ValueError("distance must be 0 to 3")
    spark = nodes.sparkSession
    kinds = masks((distance + 2) // 2)
    whole = [not w for _, w in kinds]
    shapes = F.array(*(F.struct(F.lit(_long(m & ~w)).alias("m"), F.lit(_long(w)).alias("w")) for m, w in kinds))
    each = nodes.select("node", "fp", F.posexplode(shapes).alias("k", "s"))
    bit = (F.col("fp").bitwiseAND(F.col("s.w")) != 0).cast("int")
    variants = each.select((F.col("k") * 2 + bit).alias("kind"), F.col("fp").bitwiseAND(F.col("s.m")).alias("part"), "node")
    # A variant with a bit left out has at most two whole segments in it: only the variants of frequent segments can be hot.
    wholes = [(k, _long(m)) for k, (m, w) in enumerate(kinds) if not w]
    segments = nodes.select(F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(m)).alias("part")) for k, m in wholes))).alias("s")).select("s.*")
    frequent = stored(segments.groupBy("k", "part").agg(F.count("*").alias("n")).where(F.col("n") > limit // 2), "frequent")
    hot_keys, named = None, variants.withColumn("k", F.shiftright("kind", 1))
    if not frequent.isEmpty():
        own = {k: [(j, _long(~w & (1 << 64) - 1)) for j, (m, w) in enumerate(kinds) if m == kinds[k][0]] for k, _ in wholes}
        near = F.coalesce(*(F.when(F.col("k") == k, F.array(*(F.struct(F.lit(j).alias("k"), F.col("part").bitwiseAND(F.lit(m)).alias("part")) for j, m in v))) for k, v in own.items()))
        suspects = stored(frequent.select(F.explode(near).alias("s")).select("s.*").distinct(), "suspects")
        counted = named.join(small(suspects), ["k", "part"]).groupBy("k", "part").agg(F.count("*").alias("n"))
        hot_keys = stored(counted.where(F.col("n") > limit).drop("n"), "hot")
        hot_keys = None if hot_keys.isEmpty() else small(hot_keys)
    cold = variants if hot_keys is None else named.join(hot_keys, ["k", "part"], "left_anti").select("kind", "part", "node")
    parts = enough(nodes, len(kinds))
    dealt = cold.repartition(parts, F.shiftright("kind", 1), "part")
    cold = dealt.mapInArrow(partial(_forest, whole, distance), "a long, b long").distinct()
    if hot_keys is None:
        return cold
    hot = named.join(hot_keys, ["k", "part"]).join(nodes.select("node", "fp"), "node").select(F.col("k").alias("kind"), "node", "fp")
    wild = [(k, _long(~sum(c) & (1 << 64) - 1 & ~w)) for k, (m, w) in enumerate(kinds) if distance >= bool(w) for c in combinations([1 << b for b in range(64) if not m >> b & 1], distance - bool(w))]
    wild = spark.createDataFrame(wild, "kind int, mask long")  # a fixed table of some thousand rows
    exploded = hot.join(F.broadcast(wild), "kind").select("kind", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "node")
    least = exploded.groupBy("kind", "mask", "key").agg(F.min("node").alias("a"), F.count("*").alias("m")).where("m > 1").drop("m")
    star = exploded.join(least, ["kind", "mask", "key"]).where("a <> node").select("a", F.col("node").alias("b")).distinct()
    return cold.union(star)


#: Ranges of the shingles' hashes, and how many of them make a band of candidates: one of BANDS bands is enough.
BINS, ROWS = 128, 5
BANDS = BINS // ROWS
#: Candidates' sketches agree to so much; a pair of similarity 0.8 is over four standard deviations (0.035) above.
LOOSE = 0.65
#: Bytes of text of one component that go to one task.
TEXT_LIMIT = 64 << 20


def all_hashes(text: bytes | None, size: int) -> np.ndarray:
    """64-bit hashes of a text's shingles, repeats included."""
    words = (text or b"").lower().split()
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles(words, size)), np.uint64)


def shingle_hashes(text: bytes | None, size: int) -> np.ndarray:
    """The set of a text's shingles as sorted 64-bit hashes."""
    return np.unique(all_hashes(text, size))


def least_hashes(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least hash in each of BINS ranges, and whether there is one."""
    at = np.searchsorted(hashes, np.arange(BINS, dtype=np.uint64) << np.uint64(57))
    found = hashes[np.minimum(at, len(hashes) - 1)] if len(hashes) else np.zeros(BINS, np.uint64)
    return found, (at < len(hashes)) & (found >> np.uint64(57) == np.arange(BINS))


def sketch(text: bytes | None, size: int) -> bytes:
    """One byte for each of BINS ranges of the shingles' hashes, from the least hash in it; 0 where there is none."""
    return _bytes(*least_hashes(shingle_hashes(text, size)))


def _bytes(found: np.ndarray, held: np.ndarray) -> bytes:
    return (held * (1 + (found & np.uint64(0xFFFFFF)) % np.uint64(255))).astype(np.uint8).tobytes()


def bands(found: np.ndarray, held: np.ndarray) -> list[int]:
    """Keys of the bands that hold a shingle, from whole hashes."""
    kept = np.where(held, found, np.uint64(0))[: BANDS * ROWS].reshape(BANDS, ROWS)
    some = held[: BANDS * ROWS].reshape(BANDS, ROWS).any(1)
    keys = [xxhash.xxh64_intdigest(kept[k].tobytes(), k) for k in np.flatnonzero(some).tolist()]
    return np.array(keys, np.uint64).view(np.int64).tolist()


def _node(texts: list) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(t or b"", 1) for t in texts], np.uint64).view(np.int64)


@lean
def _marks(size: int, batches):
    for batch in slices(batches):
        texts = batch.column(1).cast(pa.binary()).to_pylist()
        least, fps = [], []
        for t in texts:
            hashes = all_hashes(t, size)
            fps.append(majority(hashes))
            least.append(least_hashes(np.unique(hashes)))
        columns = [pa.array(_node(texts)), pa.array(np.array(fps, np.uint64).view(np.int64)), pa.array([len(t or b"") for t in texts], pa.int64()), pa.array([bands(*x) for x in least], pa.list_(pa.int64())), pa.array([_bytes(*x) for x in least], pa.binary())]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["id", "node", "fp", "bytes", "bands", "sketch"])


def _runs(part: np.ndarray) -> tuple[np.ndarray, list]:
    """The order of a column's equal values, and the positions of each value that is there twice or more."""
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.diff(part[order])) + 1
    return order, [x for x in np.split(order, cuts) if len(x) > 1]


@lean
def _sketched(least, batches):
    """A partition of (part, node, sketch) -> a spanning forest of each part's pairs whose sketches agree to ``least``."""
    if not (batches := list(batches)):
        return
    table = pa.Table.from_batches(batches)
    if not table.num_rows:
        return
    sketches = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint8).reshape(-1, BINS)
    yield _spanned(table["node"].to_numpy(), _runs(table["part"].to_numpy())[1], lambda x, left: similar(sketches[x], sketches[left]) >= least)


@lean
def _texts(batches):
    """(node, text), once in each partition."""
    seen: set[int] = set()
    for batch in slices(batches):
        texts = batch.column(0).cast(pa.binary())
        node = _node(texts.to_pylist())
        new = []
        for i, x in enumerate(node.tolist()):
            if x not in seen:
                seen.add(x)
                new.append(i)
        yield pa.RecordBatch.from_arrays([pa.array(node[new]), texts.take(pa.array(new, pa.int64()))], ["node", "text"])


@lean
def _exact(size, similarity, batches):
    """A partition of (part, node, text), ordered by part -> a spanning forest of each part's links."""
    part, found = None, {}
    for batch in batches:
        for p, n, t in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            if p != part:
                yield _linked(found, similarity)
                part, found = p, {}
            if n not in found:
                found[n] = shingle_hashes(t, size)
    yield _linked(found, similarity)


def _linked(found: dict[int, np.ndarray], similarity: float) -> pa.RecordBatch:
    sets = [x for x in found.values() if len(x)]
    node = np.array([n for n, x in found.items() if len(x)], np.int64)
    if len(sets) < 2:
        return _spanned(node, [], None)
    sizes = np.array([len(x) for x in sets])
    values, which = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.r_[0, np.cumsum(sizes)]
    flag = np.zeros(len(values), np.int32)

    def near(x, left):
        # The sizes alone bound the similarity.
        able = (np.minimum(sizes[left], sizes[x]) >= similarity * np.maximum(sizes[left], sizes[x]) - 1e-6).nonzero()[0]
        out = np.zeros(len(left), bool)
        own = which[starts[x] : starts[x + 1]]
        flag[own] = 1
        both = np.array([flag[which[starts[y] : starts[y + 1]]].sum() for y in left[able]], np.int64)
        flag[own] = 0
        out[able] = both >= similarity * (sizes[x] + sizes[left[able]] - both) - 1e-9
        return out

    return _spanned(node, [np.arange(len(sets))], near)


def fingerprint_links(nodes: DataFrame, distance: int, limit: int) -> DataFrame:
    """Edges (a, b) between ``nodes`` (node, fp), whose components are those of all fingerprints at ``distance`` or nearer."""
    firsts = stored(nodes.groupBy("fp").agg(F.min("node").alias("first")), "fingerprints")
    links = candidate_links(firsts.select(F.col("fp").alias("node"), "fp"), distance, limit)
    a, b = (firsts.select(F.col("fp").alias(x), F.col("first").alias(f"first_{x}")) for x in "ab")
    near = links.join(a, "a").join(b, "b").select(F.col("first_a").alias("a"), F.col("first_b").alias("b"))
    equal = nodes.join(firsts, "fp").where("first <> node").select(F.col("first").alias("a"), F.col("node").alias("b"))
    return near.union(equal)


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8, limit: int = LIMIT, text_limit: int = TEXT_LIMIT, distance: int = 2) -> DataFrame:
    """One row for each document: id and component_id (the smallest id of its group of exact and near copies).
    Candidates, by fingerprints at ``distance`` or nearer and by bands, are meant for a ``similarity`` of about 0.8 and more."""
    few_rows(docs.sparkSession)
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    marked = stored(narrow.mapInArrow(partial(_marks, shingle), "id long, node long, fp long, bytes long, bands array<long>, sketch binary"), "marks")
    nodes = stored(marked.groupBy("node").agg(F.min("id").alias("least"), *(F.first(x).alias(x) for x in ("fp", "bytes", "bands", "sketch"))), "nodes")
    near = stored(fingerprint_links(nodes.select("node", "fp"), distance, limit), "near")
    keyed = nodes.select("node", F.explode("bands").alias("part"))
    counts = keyed.groupBy("part").agg(F.count("*").alias("n")).where("n > 1")
    shared = stored(keyed.join(small(stored(counts, "bands")), "part"), "shared")
    many = shared.where(F.col("n") > limit)
    dealt = shared.where(F.col("n") <= limit).select("part", "node")
    if not many.isEmpty():
        dealt = dealt.union(paired(many, ["part"], F.ceil(2 * F.col("n") / limit)).select("part", "node"))
    dealt = stored(dealt, "dealt")
    sketched = dealt.join(nodes.select("node", "sketch"), "node").repartition(enough(dealt), "part")
    loose = connected_components(near.union(sketched.mapInArrow(partial(_sketched, min(LOOSE, similarity)), "a long, b long")))
    members = stored(loose.withColumnRenamed("v", "node").join(nodes.select("node", "bytes"), "node"), "members")
    size = members.groupBy("root").agg(F.sum("bytes").alias("all"))
    members = stored(members.join(size, "root"), "members")
    groups, large = members.where(F.col("all") <= text_limit).select("node", F.col("root").alias("part")), members.where(F.col("all") > text_limit)
    if not large.isEmpty():
        groups = groups.union(paired(large, ["root"], F.greatest(F.lit(3), F.ceil(2 * F.col("all") / text_limit))).select("node", "part"))
    groups = stored(groups, "groups")
    texts = narrow.select("text").mapInArrow(_texts, "node long, text binary").join(small(groups), "node").select("part", "node", "text")
    links = texts.repartition(enough(groups), "part").sortWithinPartitions("part").mapInArrow(partial(_exact, shingle, similarity), "a long, b long")
    roots = connected_components(links)
    return _named(marked.select("id", "node"), nodes.select("node", "least"), roots).select(F.col("id").alias(id_col), "component_id")


def _named(marked: DataFrame, nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """``marked`` (id, node) with component_id, the least id of the component of its node."""
    rooted = nodes.join(roots.withColumnRenamed("v", "node"), "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    rooted = stored(rooted, "rooted")
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return marked.join(rooted.join(smallest, "root").select("node", "component_id"), "node")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 2) -> DataFrame:
    """One row for each document: id, fingerprint (16 hex digits), component_id (smallest id reachable)."""
    marked = stored(fingerprints(docs, id_col, text_col, shingle).withColumnRenamed("fp", "node"), "fingerprints")
    nodes = stored(marked.groupBy("node").agg(F.min("id").alias("least")), "distinct")
    roots = connected_components(candidate_links(nodes.select("node", F.col("node").alias("fp")), distance))
    out = _named(marked, nodes, roots)
    return out.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("node"), 16, "0")).alias("fingerprint"), "component_id")
