"""Approximate nearest neighbours through an inverted multi-index.

Vectors are cut into two halves, each quantised by its own codebook; a cell is a pair of centroids. A query walks the
cells in the order of summed squared distances to its halves' centroids, by a heap, until the cells visited hold
``candidates`` vectors; all vectors of those cells are ranked by exact Euclidean distance in double precision.

How many candidates that takes depends on the vectors (few if they are clustered, half of all if they spread evenly in
all directions), so it is measured: ``probes`` rows of the table (those with the smallest hashes of their ids) are
compared with all vectors by brute force, in one pass, and ``candidates`` is the least number at which the walks of
these rows come by the share ``recall`` of their true neighbours.

The codebooks are fitted on at most ``sample`` vectors (the smallest hashes again) and grow with the square root of the
table; every vector is indexed. Entries meet queries in blocks: cells with neighbouring first centroids share a block,
a first centroid with many vectors gets several, and the queries that visit a block are dealt out likewise, so a task
holds a bounded block of each. No cell has a cap. Of equal vectors only the k + 1 smallest ids are indexed, as no others
can be among the nearest k; that choice is made in two steps, so many copies don't meet in one task.

Defined cases: vectors that are null, zero, of another length than the commonest, or that hold null or non-finite
components take no part, nor do rows without id; of query rows repeated with one id the smallest vector is asked;
rows with the query's id are never its result; with fewer than k candidates all are returned; ties go to the smaller
id; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from functools import partial
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sluice.llm.common import lean, release, small, stored

SAMPLE, ROUNDS, SEED = 20_000, 12, 7
#: Rows that the number of candidates is measured on, and the share of their true neighbours that it has to reach.
PROBES, RECALL = 200, 0.97
#: A codebook has at most so many centroids, so the table of cell counts has at most its square.
MOST_CENTROIDS = 512
#: Vectors and queries that meet in a group, about.
BLOCK = 4096


def clean_vectors(frame: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    sound = frame.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return sound.where(F.col("id").isNotNull() & F.col("v").isNotNull()).where(~odd & F.exists("v", lambda x: x != 0))


def matrix(column) -> np.ndarray:
    """Rows of one length as a double matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.asarray(flat, np.float64).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a to all of b."""
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T, 0)


def fit_codebook(points: np.ndarray, k: int, seed: int = SEED) -> np.ndarray:
    """Lloyd's algorithm from a seeded k-means++ start."""
    rng = np.random.default_rng(seed)
    centroids = points[rng.integers(len(points))][None]
    near = distances(points, centroids)[:, 0]
    while len(centroids) < k and near.sum() > 0:
        centroids = np.vstack([centroids, points[rng.choice(len(points), p=near / near.sum())]])
        near = np.minimum(near, distances(points, centroids[-1:])[:, 0])
    for _ in range(ROUNDS):
        own = distances(points, centroids).argmin(1)
        count = np.bincount(own, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, points)
        centroids = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centroids)
    return centroids


def walk(a: np.ndarray, b: np.ndarray, counts: np.ndarray, candidates: int) -> list[int]:
    """Cells in the order of a[i] + b[j], until those visited hold at least ``candidates`` vectors."""
    by_a, by_b = a.argsort(kind="stable"), b.argsort(kind="stable")
    heap, cells, held = [(a[by_a[0]] + b[by_b[0]], 0, 0)], [], 0
    while heap and held < candidates:
        _, i, j = heappop(heap)
        cell = int(by_a[i]) * len(b) + int(by_b[j])
        if counts[cell]:
            cells.append(cell)
            held += counts[cell]
        if j + 1 < len(b):
            heappush(heap, (a[by_a[i]] + b[by_b[j + 1]], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heappush(heap, (a[by_a[i + 1]] + b[by_b[0]], i + 1, 0))
    return cells


def deal(counts: np.ndarray, k_b: int) -> tuple[np.ndarray, np.ndarray]:
    """For each first centroid its first block and the number of its blocks."""
    first, parts, block, held = [], [], 0, 0
    for n in counts.reshape(-1, k_b).sum(1):
        if n > BLOCK:
            block += held > 0
            first.append(block)
            parts.append(-(-n // BLOCK))
            block, held = block + parts[-1], 0
            continue
        if held + n > BLOCK:
            block, held = block + 1, 0
        first.append(block)
        parts.append(1)
        held += n
    return np.array(first), np.array(parts)


@lean
def _assign(books, batches):
    half = books[0].shape[1]
    for batch in batches:
        x = matrix(batch.column(1))
        cell = distances(x[:, :half], books[0]).argmin(1) * len(books[1]) + distances(x[:, half:], books[1]).argmin(1) if len(x) else []
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.asarray(cell, np.int32))], ["id", "v", "cell"])


@lean
def _probe(books, counts, dealt, candidates, batches):
    """A row for each query and block that holds visited cells, with those cells."""
    half, (first, parts) = books[0].shape[1], dealt
    for batch in batches:
        x, rows, blocks, visits = matrix(batch.column(1)), [], [], []
        if not len(x):
            continue
        a, b = distances(x[:, :half], books[0]), distances(x[:, half:], books[1])
        for i in range(len(x)):
            cells = np.array(walk(a[i], b[i], counts, candidates), np.int32)
            at = first[cells // len(books[1])]
            for block in np.unique(at):
                own = np.sort(cells[at == block])
                for part in range(parts[own[0] // len(books[1])]):
                    rows.append(i)
                    blocks.append(block + part)
                    visits.append(own.tobytes())
        taken = [c.take(pa.array(rows, pa.int64())) for c in batch.columns]
        yield pa.RecordBatch.from_arrays([*taken, pa.array(blocks, pa.int32()), pa.array(visits, pa.binary())], ["id", "v", "block", "cells"])


def _rank(k, entries: pa.Table, probes: pa.Table) -> pa.Table:
    ids, cells = entries["id"].to_numpy(), entries["cell"].to_numpy()
    order = np.lexsort((ids, cells))
    e, ids, cells = matrix(entries["v"])[order], ids[order], cells[order]
    q, asked, visits, out = matrix(probes["v"]), probes["id"].to_numpy(), probes["cells"].to_pylist(), []
    for i in range(len(q) if len(e) else 0):
        wanted = np.frombuffer(visits[i], np.int32)
        hit = np.flatnonzero(wanted[np.minimum(np.searchsorted(wanted, cells), len(wanted) - 1)] == cells)
        hit = hit[ids[hit] != asked[i]]
        if not len(hit):
            continue
        rough = distances(q[i : i + 1], e[hit])[0]
        if len(hit) > k:
            hit = hit[rough <= np.partition(rough, k - 1)[k - 1] * (1 + 1e-9) + 1e-9]
        exact = np.sqrt(((e[hit] - q[i]) ** 2).sum(1))
        top = np.lexsort((ids[hit], exact))[:k]
        out.append((np.full(len(top), asked[i]), ids[hit][top], exact[top]))
    parts = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0)] * 3
    release()
    return pa.table({"query_id": parts[0].astype(np.int64), "id": parts[1].astype(np.int64), "score": parts[2].astype(np.float64)})


@lean
def _true_neighbours(k, ids, points, batches):
    """The k nearest rows of a partition to each probe."""
    best: list = []
    for batch in batches:
        x, own, cell = matrix(batch.column(1)), batch.column(0).to_numpy(), batch.column(2).to_numpy()
        if not len(x):
            continue
        d = distances(points, x)
        d[ids[:, None] == own[None]] = np.inf
        top = np.argsort(d, axis=1, kind="stable")[:, :k]
        best.append((np.repeat(np.arange(len(ids)), top.shape[1]), cell[top].ravel(), np.take_along_axis(d, top, 1).ravel(), own[top].ravel()))
    if best:
        at, cell, d, own = (np.concatenate(x) for x in zip(*best, strict=True))
        order = np.lexsort((own, d, at))
        at, cell, d, own = at[order], cell[order], d[order], own[order]
        first = np.searchsorted(at, np.arange(len(ids)))
        kept = (np.arange(len(at)) - first[at] < k) & np.isfinite(d)
        yield pa.RecordBatch.from_arrays([pa.array(at[kept].astype(np.int32)), pa.array(cell[kept]), pa.array(d[kept]), pa.array(own[kept])], ["probe", "cell", "d", "id"])


def measured(index: DataFrame, books, counts: np.ndarray, ids: np.ndarray, points: np.ndarray, k: int, recall: float) -> int:
    """The least number of candidates at which walks from ``points`` come by ``recall`` of their true neighbours."""
    found = index.mapInArrow(partial(_true_neighbours, k, ids, points), "probe int, cell int, d double, id long")
    order = F.row_number().over(W.partitionBy("probe").orderBy("d", "id"))
    found = found.withColumn("rn", order).where(F.col("rn") <= k).select("probe", "cell").toPandas()  # at most probes times k rows
    half, needed = books[0].shape[1], []
    a, b = distances(points[:, :half], books[0]), distances(points[:, half:], books[1])
    for probe, cells in found.groupby("probe")["cell"]:
        visit = (a[probe][:, None] + b[probe][None]).ravel().argsort(kind="stable")
        before = np.empty(len(visit), np.int64)
        before[visit] = np.cumsum(counts[visit]) - counts[visit]
        needed.append(before[cells.to_numpy()])
    if not needed:
        return int(counts.sum())
    needed = np.sort(np.concatenate(needed))
    return int(needed[min(len(needed), int(np.ceil(recall * len(needed)))) - 1]) + 1


class Index:
    """Codebooks, cells of all vectors (a stored table), their counts, and the candidates a walk has to come by."""

    def __init__(self, vectors: DataFrame, k: int, candidates: int | None, recall: float, id_col: str, vec_col: str, sample: int, probes: int):
        sound = clean_vectors(vectors, id_col, vec_col)
        length = sound.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("c")).agg(F.max(F.struct("c", "n"))).first()[0]
        self.size, self.candidates = (length["n"], candidates) if length is not None else (0, 0)
        if not self.size:
            return
        sound = sound.where(F.size("v") == self.size)
        # Of equal vectors the k + 1 smallest ids: first among those of one salt, then among those left.
        salted = W.partitionBy("key", "v", "salt").orderBy("id")
        kept = sound.withColumns({"key": F.xxhash64("v"), "salt": F.pmod(F.xxhash64("id"), F.lit(64))}).withColumn("rn", F.row_number().over(salted)).where(F.col("rn") <= k + 1)
        kept = kept.withColumn("rn", F.row_number().over(W.partitionBy("key", "v").orderBy("id"))).where(F.col("rn") <= k + 1).select("id", "v")
        drawn = sound.orderBy(F.xxhash64("id"), "id").limit(sample).toPandas()  # at most ``sample`` rows
        points, half = np.array(drawn["v"].tolist(), np.float64), max(1, self.size // 2)
        centroids = int(np.clip(2 ** round(np.log2(max(2.0, (length["c"] / 3) ** 0.5))), 2, MOST_CENTROIDS))
        self.books = [fit_codebook(points[:, :half], centroids), fit_codebook(points[:, half:], centroids) if self.size > 1 else np.zeros((1, 0))]
        self.cells = stored(kept.mapInArrow(partial(_assign, self.books), "id long, v array<double>, cell int"), "cells")
        self.counts = np.zeros(len(self.books[0]) * len(self.books[1]), np.int64)
        held = self.cells.groupBy("cell").agg(F.count("*").alias("n")).toPandas()  # a row a cell, at most MOST_CENTROIDS squared
        self.counts[held["cell"].to_numpy()] = held["n"].to_numpy()
        if candidates is None:
            ids = drawn["id"].to_numpy()[:probes]
            self.candidates = measured(self.cells, self.books, self.counts, ids, points[: len(ids)], k, recall)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, candidates: int | None = None, recall: float = RECALL, id_col: str = "vec_id", vec_col: str = "embedding", sample: int = SAMPLE, probes: int = PROBES) -> DataFrame:
    """(query_id, rank, id, score): the k nearest found for each query row, nearest first. ``candidates`` is measured
    for the ``recall`` unless it is given."""
    return search(Index(vectors, k, candidates, recall, id_col, vec_col, sample, probes), queries, k, id_col, vec_col)


def search(index: Index, queries: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    spark = queries.sparkSession
    if not index.size:
        return spark.createDataFrame([], "query_id long, rank int, id long, score double")
    books, counts, parts = index.books, index.counts, int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = deal(counts, len(books[1]))
    asked = clean_vectors(queries, id_col, vec_col).where(F.size("v") == index.size).groupBy("id").agg(F.min("v").alias("v"))
    walked = asked.repartition(parts, "id").mapInArrow(partial(_probe, books, counts, dealt, index.candidates), "id long, v array<double>, block int, cells binary")
    probes = stored(walked, "probes")
    visitors = stored(probes.groupBy("block").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("nq")), "visitors")
    centroid = F.floor(F.col("cell") / len(books[1])) + 1
    at = lambda array: F.element_at(F.lit([int(x) for x in array]), centroid.cast("int"))
    entries = index.cells.withColumn("block", (at(dealt[0]) + F.pmod(F.xxhash64("id"), at(dealt[1]))).cast("int"))
    entries = entries.join(small(visitors), "block").select("block", F.explode(F.sequence(F.lit(0), F.col("nq") - 1)).alias("part"), "id", "v", "cell")
    wanted = probes.join(small(visitors), "block").select("block", F.pmod(F.xxhash64("id"), F.col("nq")).cast("int").alias("part"), "id", "v", "cells")
    ranked = entries.groupBy("block", "part").cogroup(wanted.groupBy("block", "part")).applyInArrow(partial(_rank, k), "query_id long, id long, score double")
    order = W.partitionBy("query_id").orderBy("score", "id")
    return ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")
