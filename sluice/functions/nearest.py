"""Exact nearest vectors by cosine of one block of queries and one block of vectors, as Arrow tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Queries and vectors that are multiplied at once; pairs that are scored at once.
QUERIES, VECTORS, PAIRS = 256, 8192, 1 << 15
#: The product of matrices adds in another order than the scores; its errors are far below this.
MARGIN = 1e-9
#: Places in the order: no number comes before all scores, as in SQL.
NAN, NOTHING = 2.0, -3.0


def rows_by_length(column: pa.ChunkedArray) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, matrix) of the lists of each length. Missing and empty lists, and lists with gaps, are in none."""
    lists = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).copy()
    if lists.flatten().null_count:
        lengths[[i for i, x in enumerate(lists.to_pylist()) if x and None in x]] = 0
    out = []
    for length in np.unique(lengths[lengths > 0]).tolist():
        rows = np.flatnonzero(lengths == length)
        out.append((length, rows, lists.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(-1, length)))
    return out


def running_sum(products: np.ndarray) -> np.ndarray:
    """Sums of rows, added from left to right, so that equal vectors have equal scores wherever they stand."""
    return np.cumsum(products, axis=1)[:, -1] + 0.0


def squares(matrix: np.ndarray) -> np.ndarray:
    parts = [matrix[i : i + PAIRS].astype(float) for i in range(0, len(matrix), PAIRS)]
    return np.concatenate([running_sum(x * x) for x in parts]) if parts else np.zeros(0)


def units(matrix: np.ndarray, squared: np.ndarray) -> np.ndarray:
    """Rows of length 1; those whose length is none, or too far from 1 to be multiplied, become NaN and are always scored."""
    plain = (squared > 1e-140) & (squared < 1e140)
    return matrix.astype(float) / np.sqrt(np.where(plain, squared, np.nan))[:, None]


def without_copies(matrix: np.ndarray, n: int) -> np.ndarray:
    """Rows but those that follow n equal ones: they can't be among the n nearest."""
    raw = np.ascontiguousarray(matrix).view(np.uint32)
    weights = np.random.default_rng(0).integers(1, 1 << 62, raw.shape[1], dtype=np.uint64) | np.uint64(1)
    hashed = np.concatenate([(raw[i : i + PAIRS] * weights).sum(axis=1, dtype=np.uint64) for i in range(0, len(raw), PAIRS)])
    order = np.argsort(hashed, kind="stable")
    first = np.flatnonzero(np.diff(hashed[order], prepend=~hashed[order[:1]]) != 0)
    sizes = np.diff(first, append=len(order))
    keep = np.ones(len(matrix), bool)
    for at, size in zip(first[sizes > n].tolist(), sizes[sizes > n].tolist()):
        run = order[at : at + size]
        if all((raw[run[i : i + PAIRS]] == raw[run[0]]).all() for i in range(0, size, PAIRS)):
            keep[run[n:]] = False
    return np.flatnonzero(keep)


def scores(asked: np.ndarray, found: np.ndarray, asked_squares: np.ndarray, found_squares: np.ndarray, q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Cosines of the pairs (q[i], v[i])."""
    out = np.empty(len(q))
    for i in range(0, len(q), PAIRS):
        a, b = q[i : i + PAIRS], v[i : i + PAIRS]
        out[i : i + PAIRS] = running_sum(asked[a].astype(float) * found[b].astype(float)) / np.sqrt(asked_squares[a] * found_squares[b])
    return np.clip(out, -1, 1)


def best(asked: np.ndarray, found: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vector, cosine): the n nearest of each query, ties to the earlier vector."""
    kept = without_copies(found, n)
    found = found[kept]
    asked_squares, found_squares = squares(asked), squares(found)
    parts = []
    for start in range(0, len(asked), QUERIES):
        some, some_squares = asked[start : start + QUERIES], asked_squares[start : start + QUERIES]
        turned, least = units(some, some_squares), np.full(len(some), -np.inf)
        q, v, score = np.zeros(0, int), np.zeros(0, int), np.zeros(0)
        for begin in range(0, len(found), VECTORS):
            end = begin + VECTORS
            near = turned @ units(found[begin:end], found_squares[begin:end]).T
            if begin == 0 and near.shape[1] > n:
                least = np.partition(np.where(np.isnan(near), NAN, near), -n, axis=1)[:, -n] - 2 * MARGIN
            new_q, new_v = np.nonzero(~(near < least[:, None]))
            if not len(new_q):
                continue
            new_v += begin
            q, v, score = np.concatenate([q, new_q]), np.concatenate([v, new_v]), np.concatenate([score, scores(some, found, some_squares, found_squares, new_q, new_v)])
            place = np.where(np.isnan(score), NAN, score)
            order = np.lexsort((v, -place, q))
            q, v, score, place = q[order], v[order], score[order], place[order]
            first = np.searchsorted(q, np.arange(len(some)))
            rank = np.arange(len(q)) - first[q]
            last = rank == n - 1
            least[q[last]] = place[last] - MARGIN
            q, v, score = q[rank < n], v[rank < n], score[rank < n]
        parts.append((q + start, kept[v], score))
    return tuple(np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))


def nearest(asked: pa.Table, found: pa.Table, n: int) -> pa.Table:
    """(query key, key, exact) from tables of (key, list): the n nearest of each query, ties to the smaller key. Pairs
    without a cosine, such as those of missing lists, come last."""
    found = found.take(pc.sort_indices(found.column(0)))
    parts, every = [], np.arange(found.num_rows)
    lists, left = {length: (rows, matrix) for length, rows, matrix in rows_by_length(found.column(1))}, np.ones(asked.num_rows, bool)
    with np.errstate(all="ignore"):
        for length, rows, matrix in rows_by_length(asked.column(1)):
            left[rows] = False
            others = every
            if length in lists:
                q, v, score = best(matrix, lists[length][1], n)
                parts.append((rows[q], lists[length][0][v], pa.array(score)))
                others = np.setdiff1d(every, lists[length][0], assume_unique=True)
            parts.append((np.repeat(rows, len(others[:n])), np.tile(others[:n], len(rows)), None))
    rows = np.flatnonzero(left)
    parts.append((np.repeat(rows, len(every[:n])), np.tile(every[:n], len(rows)), None))
    out = [pa.table({"q": asked.column(0).take(pa.array(q)), "k": found.column(0).take(pa.array(v)), "exact": pa.nulls(len(q), pa.float64()) if score is None else score}) for q, v, score in parts]
    return pa.concat_tables(out)
