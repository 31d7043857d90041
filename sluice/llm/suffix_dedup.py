"""Suffix-array dedup: removes bytes covered by a ``SPAN``-byte string that also starts in a smaller document.

Suffixes are sorted where they can matter. Anchors are the minimisers of all SPAN-byte strings (the ``GRAM``-byte grams
of least hash among the REACH + 1 in each), so equal strings have an anchor at the same place, and there is about one
in 16 bytes. An anchor's surroundings are the REACH bytes before it and the SPAN bytes from it on, which hold every
SPAN-byte string that contains it.

1. Anchors are grouped by their gram's hash. Of those with equal surroundings all but the smallest document's are
   covered whole; each task settles this for its own texts before it sends anything. Surroundings count as equal if
   their BLAKE2b digests of 128 bits are, so that no text, not even one made for it, can lose bytes to a chance hash.
   Grams of one document are dropped. What remains are the edges of repeats.
2. For those the bytes are fetched, and their suffixes (from the anchor onwards) and reversed prefixes are sorted deep-
   shallow: multikey quicksort (partition by smaller than, equal to and larger than a pivot; eight bytes are a
   character) to a shallow depth, then a blind trie for each group of longer common prefixes. For each of the REACH + 1 strings through an anchor, suffix and prefix order with their
   common prefixes give the classes of equal strings, and each class its smallest document.
3. Grams with over ``HOT`` edges (a passage in very many documents) are taken apart into their strings, which are dealt
   out by their own hashes after each task has settled its equal ones.

Texts move packed and compressed, in groups of about ``GROUP`` bytes; a longer text is a group of its own, and its
anchors are found in overlapping pieces.

A row is told apart by its id and a tag of its text, so rows that share an id are judged each by its own text, and
neither they nor rows without id gather in one task.

Defined cases: null and empty texts have no bytes and lose none; rows with null id lose nothing and cost others
nothing; rows repeated with one id never count against each other; texts that are equal keep the smallest id's copy
(texts under SPAN bytes are kept); an empty table gives an empty result; input columns named kept or removed are
replaced; all others pass through.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.common import few_rows, lean, release, slices, stored

SPAN, GRAM = 50, 20
REACH = SPAN - GRAM
GROUP, PIECE, HOT = 4 << 20, 1 << 18, 20_000
MARGIN = 2 * SPAN
SHALLOW = 3  # words of eight bytes
MAX = np.uint64(2**64 - 1)
BASE, UNBASE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
COVER, EDGES, STRINGS = 0, 1, 2
#: A position holds the tag of its text above so many bits.
TAGGED, TAGS = 40, (1 << 22) - 1


# ---------------------------------------------------------------- packing
def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of one length, by columns, compressed."""
    raw = b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)
    return struct.pack("<I", len(arrays[0])) + zstandard.ZstdCompressor(level=1).compress(raw)


def unpack(blob: bytes, *kinds) -> list[np.ndarray]:
    n, at, out = struct.unpack_from("<I", blob)[0], 0, []
    raw = zstandard.ZstdDecompressor().decompress(blob[4:]) if n else b""
    for kind in map(np.dtype, kinds):
        out.append(np.frombuffer(raw, kind, n, at))
        at += n * kind.itemsize
    return out


def gathered(blobs: list[bytes], *kinds) -> list[np.ndarray]:
    parts = [unpack(b, *kinds) for b in blobs]
    return [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [np.zeros(0, k) for k in kinds]


def ranges(sorted_keys: np.ndarray):
    """(first, end) of each run of equal keys."""
    cuts = np.flatnonzero(sorted_keys[1:] != sorted_keys[:-1]) + 1
    return zip(np.r_[0, cuts], np.r_[cuts, len(sorted_keys)], strict=True) if len(sorted_keys) else ()


def dealt(keys: np.ndarray, kind: int, columns: list[np.ndarray], rows: list) -> None:
    """Appends (key, kind, packed rows of that key) for each key."""
    order = keys.argsort(kind="stable")
    keys, columns = keys[order], [c[order] for c in columns]
    for lo, hi in ranges(keys):
        rows.append((int(keys[lo]), kind, pack(*(c[lo:hi] for c in columns))))


def batch_of(rows: list) -> pa.RecordBatch:
    keys, kinds, blobs = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array(kinds, pa.int32()), pa.array(blobs, pa.binary())], ["key", "kind", "blob"])


ROWS = "key int, kind int, blob binary"
COVERS, ANCHORS, ASKED = ("<i8", "<i8", "<i8"), ("<u8", "V16", "<i8", "<i8"), ("<i8", "<i8", "<u8", "<u1")


def tag(text: bytes) -> int:
    return zlib.crc32(text) & TAGS


def place(doc: np.ndarray, tags: np.ndarray, groups: int) -> np.ndarray:
    """The group of texts that a text is in."""
    return np.mod(np.mod(doc, groups) + tags, groups)


def digests(strings) -> np.ndarray:
    return np.frombuffer(b"".join([hashlib.blake2b(x, digest_size=16).digest() for x in strings]), "V16")


# ---------------------------------------------------------------- anchors
@lru_cache(maxsize=8)
def powers(base: int, n: int) -> np.ndarray:
    out, k = np.ones(n, np.uint64), 1
    while k < n:
        m = min(k, n - k)
        out[k : k + m] = out[:m] * np.uint64(pow(base, k, 1 << 64))
        k += m
    return out


def sliding(fold, x: np.ndarray, width: int) -> np.ndarray:
    """fold (minimum or maximum) over all windows of x, by doubling."""
    s = 1
    while s * 2 <= width:
        x, s = fold(x[:-s], x[s:]), s * 2
    return fold(x[: len(x) - (width - s)], x[width - s :]) if s < width else x


def anchors(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of pieces data[cuts[i]:cuts[i + 1]], each of at least SPAN bytes: positions of the anchors, their pieces, the
    hashes of their grams, and the digests of their surroundings and place in them."""
    size = 1 << max(19, int(len(data) + 1).bit_length())
    p, q = powers(BASE, size), powers(UNBASE, size)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * p[: len(data)], out=sums[1:])
    h = (sums[GRAM:] - sums[:-GRAM]) * q[: len(data) - GRAM + 1]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    across = (cuts[1:-1, None] - np.arange(1, GRAM)).ravel()
    h[across] = MAX
    least = np.concatenate([np.zeros(REACH, np.uint64), sliding(np.minimum, h, REACH + 1), np.zeros(REACH, np.uint64)])
    at = np.flatnonzero((sliding(np.maximum, least, REACH + 1) == h) & (h != MAX))
    piece = np.searchsorted(cuts, at, "right") - 1
    lo, hi = np.maximum(at - REACH, cuts[piece]), np.minimum(at + SPAN, cuts[piece + 1])
    raw, places = data.tobytes(), [bytes([k]) for k in range(REACH + 1)]
    around = digests(raw[a:b] + places[k - a] for a, k, b in zip(lo.tolist(), at.tolist(), hi.tolist(), strict=True))
    return at, piece, h[at], around


def pieces(ids: list[int], texts: list[bytes]):
    """Lots of (id, bytes, offset in the text, first and last anchor position to keep, tag), of about PIECE bytes."""
    lot, held = [], 0
    for i, t in zip(ids, texts, strict=True):
        own = tag(t) if len(t) >= SPAN else 0
        for lo in range(0, len(t), PIECE):
            hi = min(len(t), lo + PIECE)
            a, b = max(0, lo - MARGIN), min(len(t), hi + MARGIN)
            if b - a >= SPAN:
                lot.append((i, t[a:b], a, lo, hi, own))
                held += b - a
            if held >= PIECE:
                yield lot
                lot, held = [], 0
    if lot:
        yield lot


def _anchored(lot: list) -> list[np.ndarray]:
    """gram, around, doc and tagged position of a lot's anchors."""
    cuts = np.cumsum([0] + [len(x[1]) for x in lot])
    at, piece, gram, around = anchors(np.frombuffer(b"".join(x[1] for x in lot), np.uint8), cuts)
    ids, offsets, first, last, tags = (np.array([x[k] for x in lot], np.int64) for k in (0, 2, 3, 4, 5))
    pos = at - cuts[piece] + offsets[piece]
    own = (pos >= first[piece]) & (pos < last[piece])
    pos += tags[piece] << TAGGED
    return [x[own] for x in (gram, around, ids[piece], pos)]


def _settled(found: list[list[np.ndarray]], groups: int, buckets: int) -> pa.RecordBatch:
    gram, around, doc, pos = (np.concatenate(x) for x in zip(*found, strict=True))
    rows: list = []
    keep = smallest(around, doc)
    cover(doc[~keep], pos[~keep], groups, buckets, rows)
    columns = [gram[keep], around[keep], doc[keep], pos[keep]]
    dealt((columns[0] % np.uint64(buckets)).astype(np.int64), EDGES, columns, rows)
    return batch_of(rows)


@lean
def _map(groups: int, buckets: int, batches):
    found, held = [], 0
    for batch in slices(batches):
        batch = batch.filter(pc.is_valid(batch.column(0)))
        for lot in pieces(batch.column(0).to_pylist(), [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]):
            found.append(_anchored(lot))
            held += sum(len(x[1]) for x in lot)
            if held >= GROUP:
                yield _settled(found, groups, buckets)
                found, held = [], 0
    if found:
        yield _settled(found, groups, buckets)


def smallest(around: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether a row's document is the smallest of those with its digest."""
    keep = np.zeros(len(doc), bool)
    if len(doc):
        halves = np.ascontiguousarray(around).view("<u8").reshape(-1, 2)
        order = halves[:, 0].argsort(kind="stable")
        x, d = halves[order], doc[order]
        cuts = np.flatnonzero(np.r_[True, (x[1:] != x[:-1]).any(1)])
        keep[order] = d == np.repeat(np.minimum.reduceat(d, cuts), np.diff(np.r_[cuts, len(d)]))
    return keep


def cover(doc, pos, groups: int, buckets: int, rows: list) -> None:
    """Whole surroundings of settled anchors, runs of one document joined, on their way through any bucket."""
    order = np.lexsort((pos, doc))
    intervals(doc[order], pos[order] - REACH, pos[order] + SPAN, groups, rows, buckets)


def intervals(doc, lo, hi, groups: int, rows: list, buckets: int = 0) -> None:
    """Deals out covered intervals, which are sorted and of similar lengths, by the documents' groups."""
    if len(doc):
        new = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (lo[1:] > hi[:-1])])
        doc, lo, hi = doc[new], lo[new], np.maximum.reduceat(hi, new)
        group = place(doc, (hi - 1) >> TAGGED, groups)
        dealt(np.mod(group, buckets) if buckets else group, COVER, [doc, lo, hi], rows)


def parts(table: pa.Table, kind: int) -> list[bytes]:
    kinds = table["kind"].to_numpy()
    return table["blob"].take(pa.array(np.flatnonzero(kinds == kind))).to_pylist()


def pass_on(table: pa.Table, groups: int, rows: list) -> None:
    doc, lo, hi = gathered(parts(table, COVER), *COVERS)
    order = np.lexsort((lo, doc))
    intervals(doc[order], lo[order], hi[order], groups, rows)


def _meet(groups, hot, table):
    """A bucket of anchors -> covered intervals, and the edges whose bytes are needed."""
    rows: list = []
    pass_on(table, groups, rows)
    gram, around, doc, pos = gathered(parts(table, EDGES), *ANCHORS)
    if len(gram):
        keep = smallest(around, doc)
        order = np.lexsort((pos[~keep], doc[~keep]))
        d, p = doc[~keep][order], pos[~keep][order]
        intervals(d, p - REACH, p + SPAN, groups, rows)
        gram, around, doc, pos = gram[keep], around[keep], doc[keep], pos[keep]
        order = gram.argsort(kind="stable")
        gram, around, doc, pos = gram[order], around[order].view("<u8")[::2], doc[order], pos[order]
        cuts = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]])
        size = np.diff(np.r_[cuts, len(gram)])
        several = (np.minimum.reduceat(doc, cuts) != np.maximum.reduceat(doc, cuts)) & (np.minimum.reduceat(around, cuts) != np.maximum.reduceat(around, cuts))
        edge = np.repeat(several, size)
        columns = [doc[edge], pos[edge], gram[edge], np.repeat(size > hot, size)[edge].astype(np.uint8)]
        dealt(place(columns[0], columns[1] >> TAGGED, groups), EDGES, columns, rows)
    release()
    return pa.Table.from_batches([batch_of(rows)])


# ---------------------------------------------------------------- bytes of the edges
@lean
def _pack_texts(groups: int, batches):
    for batch in batches:
        batch = batch.filter(pc.is_valid(batch.column(0)))
        ids, texts = batch.column(0).to_numpy(), batch.column(1).cast(pa.binary()).to_pylist()
        own, rows = place(ids, np.array([tag(t or b"") for t in texts], np.int64), groups), []
        order = own.argsort(kind="stable")
        squeeze = zstandard.ZstdCompressor(level=1)
        for lo, hi in ranges(own[order]):
            some = [(int(ids[i]), texts[i]) for i in order[lo:hi] if texts[i] and len(texts[i]) >= SPAN]
            if some:
                head = np.array([x for i, t in some for x in (i, len(t))], np.int64).tobytes()
                rows.append((int(own[order[lo]]), COVER, struct.pack("<I", len(some)) + squeeze.compress(head + b"".join(t for _, t in some))))
        yield batch_of(rows)


def _fetch(buckets: int, groups: int, texts: pa.Table, asked: pa.Table) -> pa.Table:
    """Surroundings of the edges, dealt out by gram; of hot grams the single strings."""
    doc, pos, gram, hot = gathered(asked["blob"].to_pylist(), *ASKED)
    rows: list = []
    if len(doc):
        order = np.lexsort((pos, doc))
        doc, pos, gram, hot = doc[order], pos[order], gram[order], hot[order].astype(bool)
        keep, around, before, after = [], [], [], []
        for blob in texts["blob"].to_pylist():
            n = struct.unpack_from("<I", blob)[0]
            raw = zstandard.ZstdDecompressor().decompress(blob[4:])
            head, at = np.frombuffer(raw, np.int64, 2 * n).reshape(n, 2), 16 * n
            for i, size in head.tolist():
                lo, hi = np.searchsorted(doc, [i, i + 1])
                base = tag(raw[at : at + size]) << TAGGED if hi > lo else 0
                fits = (pos[lo:hi] >= base) & (pos[lo:hi] < base + size)  # of rows that share an id each has its own
                if fits.any():
                    own = np.frombuffer(raw, np.uint8, size, at)
                    p, span = pos[lo:hi][fits] - base, np.arange(-REACH, SPAN)
                    where = p[:, None] + span
                    around.append(np.where((where >= 0) & (where < size), own[np.clip(where, 0, size - 1)], 0).astype(np.uint8))
                    keep.append(np.arange(lo, hi)[fits])
                    before.append(np.minimum(p, REACH))
                    after.append(np.minimum(size - p, SPAN))
                at += size
        if keep:
            keep, around, before, after = (np.concatenate(x) for x in (keep, around, before, after))
            doc, pos, gram, hot = doc[keep], pos[keep], gram[keep], hot[keep]
            cold = ~hot
            columns = [gram, doc, pos, before.astype(np.uint8), after.astype(np.uint8), around.view(f"V{REACH + SPAN}").ravel()]
            dealt((gram[cold] % np.uint64(buckets)).astype(np.int64), EDGES, [c[cold] for c in columns], rows)
            if hot.any():
                _take_apart(doc[hot], pos[hot], before[hot], after[hot], around[hot], buckets, groups, rows)
    release()
    return pa.Table.from_batches([batch_of(rows)])


def _take_apart(doc, pos, before, after, around, buckets: int, groups: int, rows: list) -> None:
    for j in range(REACH + 1):
        whole = (before >= j) & (after >= SPAN - j)
        if whole.any():
            strings = np.ascontiguousarray(around[whole, REACH - j : REACH - j + SPAN])
            hashes = digests(map(np.ndarray.tobytes, strings))
            d, p = doc[whole], pos[whole] - j
            keep, hashes = smallest(hashes, d), hashes.view("<u8")[::2]
            order = np.lexsort((p[~keep], d[~keep]))
            intervals(d[~keep][order], p[~keep][order], p[~keep][order] + SPAN, groups, rows, buckets)
            dealt((hashes[keep] % np.uint64(buckets)).astype(np.int64), STRINGS, [hashes[keep], d[keep], p[keep], strings[keep].view(f"V{SPAN}").ravel()], rows)


# ---------------------------------------------------------------- deep-shallow sorting
def common_bytes(x: np.ndarray) -> np.ndarray:
    """Equal leading bytes of two words, given their exclusive or (not 0)."""
    n = np.zeros(len(x), np.int64)
    for b in (32, 16, 8):
        zero = x >> np.uint64(64 - b) == 0
        n += zero * (b // 8)
        x = np.where(zero, x << np.uint64(b), x)
    return n


def blind_trie(strings: list[bytes]) -> tuple[list[int], list[int]]:
    """Order of strings of one length, and each one's common prefix with the one before (-1 for the first).

    Inner nodes hold only a depth and branches. A string goes down blindly to some leaf, is compared with it once,
    and is put in where their common prefix ends.
    """
    size = len(strings[0])
    numbers = [int.from_bytes(s, "big") for s in strings]
    root = [size, [0]]  # a leaf has the full depth and the strings that are equal
    for i in range(1, len(strings)):
        s, node = strings[i], root
        while node[0] < size:
            node = node[1].get(s[node[0]]) or next(iter(node[1].values()))
        differ = numbers[i] ^ numbers[node[1][0]]
        if not differ:
            node[1].append(i)
            continue
        depth, above, node = size - (differ.bit_length() + 7) // 8, None, root
        while node[0] < depth:
            above, node = node, node[1][s[node[0]]]
        if node[0] == depth:
            node[1][s[depth]] = [size, [i]]
            continue
        some = node
        while some[0] < size:
            some = next(iter(some[1].values()))
        other = strings[some[1][0]]
        new = [depth, {other[depth]: node, s[depth]: [size, [i]]}]
        if above is None:
            root = new
        else:
            above[1][s[above[0]]] = new
    order, lcp, todo = [], [], [(root, -1)]
    while todo:
        node, before = todo.pop()
        if node[0] == size:
            order += node[1]
            lcp += [before] + [size] * (len(node[1]) - 1)
        else:
            kids = [k for _, k in sorted(node[1].items(), key=lambda x: x[0])]
            todo += [(k, node[0]) for k in kids[:0:-1]] + [(kids[0], before)]
    return order, lcp


def multikey_quicksort(order: np.ndarray, lo: np.ndarray, hi: np.ndarray, words: np.ndarray, depth: int) -> list[tuple[int, int]]:
    """Sorts the groups order[lo:hi] by their first ``depth`` words, in place; returns those left equal in all of them.

    A group is parted by a pivot, the median of three of its words, into smaller, equal and larger; the equal part goes
    on with the next word. All groups of a round are parted at once."""
    at, equal = np.zeros(len(lo), np.int64), []
    while len(lo):
        size = hi - lo
        base = np.cumsum(size) - size
        g = np.repeat(np.arange(len(lo)), size)
        slots = np.arange(len(g)) - base[g] + lo[g]
        rows = order[slots]
        w = words[rows, at[g]]
        a, b, c = w[base], w[base + size // 2], w[base + size - 1]
        pivot = np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c))[g]
        start, ends = lo, []
        for part in (w < pivot, w == pivot, w > pivot):
            before = np.cumsum(part) - part
            order[(start[g] + before - before[base][g])[part]] = rows[part]
            start = start + np.add.reduceat(part, base)
            ends.append(start)
        parts = [(lo, ends[0], at), (ends[0], ends[1], at + 1), (ends[1], ends[2], at)]
        lo, hi, at = (np.concatenate(x) for x in zip(*parts, strict=True))
        open_ = hi - lo > 1
        deep = open_ & (at == depth)
        equal += zip(lo[deep].tolist(), hi[deep].tolist(), strict=True)
        lo, hi, at = (x[open_ & ~deep] for x in (lo, hi, at))
    return equal


def deep_shallow(keys: np.ndarray, strings: np.ndarray, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of ``strings`` (bytes, of one width) by key, then string; and each row's common prefix with
    the one before in that order (-1 where the key changes)."""
    n, width = strings.shape
    padded = np.zeros((n, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = strings
    words = padded.view(">u8").astype(np.uint64)
    order = keys.argsort(kind="stable")
    if not n:
        return order, np.zeros(0, np.int64)
    first = np.r_[True, keys[order][1:] != keys[order][:-1]]
    lo, hi = np.flatnonzero(first), np.r_[np.flatnonzero(first)[1:], n]
    several = hi - lo > 1
    tries = multikey_quicksort(order, lo[several], hi[several], words, min(shallow, words.shape[1]))
    lcp, inner = np.where(first, -1, width), {}
    for a, b in tries:
        rows = order[a:b]
        within, common = blind_trie([x.tobytes() for x in strings[rows]])
        order[a:b] = rows[within]
        inner[a] = common[1:]
    differ = words[order[1:]] ^ words[order[:-1]]
    at = (differ != 0).argmax(1)
    x = differ[np.arange(n - 1), at]
    found = (x != 0) & ~first[1:]
    lcp[1:][found] = np.minimum(width, 8 * at[found] + common_bytes(x[found]))
    for a, common in inner.items():
        lcp[a + 1 : a + 1 + len(common)] = common
    return order, lcp


def classes(order: np.ndarray, lcp: np.ndarray, depth: int) -> np.ndarray:
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(lcp < depth)
    return out


def _sort(groups, table):
    """A bucket of edges -> covered intervals."""
    rows: list = []
    pass_on(table, groups, rows)
    gram, doc, pos, before, after, around = gathered(parts(table, EDGES), "<u8", "<i8", "<i8", "<u1", "<u1", f"V{REACH + SPAN}")
    if len(gram):
        around = np.ascontiguousarray(around).view(np.uint8).reshape(-1, REACH + SPAN)
        suffixes = deep_shallow(gram, np.ascontiguousarray(around[:, REACH:]))
        prefixes = deep_shallow(gram, np.ascontiguousarray(around[:, REACH - 1 :: -1]), 2)
        low, high = np.full(len(gram), REACH + 1), np.full(len(gram), -1)
        for j in range(REACH + 1):
            whole = (before >= j) & (after >= SPAN - j)
            key = classes(*suffixes, SPAN - j) * (len(gram) + 1) + classes(*prefixes, j)
            order = key.argsort(kind="stable")
            k, d = key[order], np.where(whole, doc, np.iinfo(np.int64).max)[order]
            cuts = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
            least = np.empty(len(gram), np.int64)
            least[order] = np.repeat(np.minimum.reduceat(d, cuts), np.diff(np.r_[cuts, len(k)]))
            found = whole & (least < doc)
            low, high = np.where(found, np.minimum(low, j), low), np.where(found, j, high)
        found = high >= 0
        d, lo, hi = doc[found], (pos - high)[found], (pos - low + SPAN)[found]
        order = np.lexsort((lo, d))
        dealt(place(d[order], (hi[order] - 1) >> TAGGED, groups), COVER, [d[order], lo[order], hi[order]], rows)
    hashes, doc, pos, strings = gathered(parts(table, STRINGS), "<u8", "<i8", "<i8", f"V{SPAN}")
    if len(hashes):
        strings = np.ascontiguousarray(strings).view(np.uint8).reshape(-1, SPAN)
        order, lcp = deep_shallow(hashes, strings)
        kind = classes(order, lcp, SPAN)
        by = kind.argsort(kind="stable")
        cuts = np.flatnonzero(np.r_[True, kind[by][1:] != kind[by][:-1]])
        least = np.empty(len(kind), np.int64)
        least[by] = np.repeat(np.minimum.reduceat(doc[by], cuts), np.diff(np.r_[cuts, len(kind)]))
        found = least < doc
        dealt(place(doc[found], pos[found] >> TAGGED, groups), COVER, [doc[found], pos[found], pos[found] + SPAN], rows)
    release()
    return pa.Table.from_batches([batch_of(rows)])


# ---------------------------------------------------------------- removal
def cut_out(text: bytes, lo: np.ndarray, hi: np.ndarray) -> tuple[bytes, list[tuple[int, int]]]:
    """What is left of a text without the intervals, and the maximal removed runs."""
    edge = np.zeros(len(text) + 1, np.int64)
    np.add.at(edge, np.clip(lo, 0, len(text)), 1)
    np.add.at(edge, np.clip(hi, 0, len(text)), -1)
    gone = np.cumsum(edge[:-1]) > 0
    turns = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8)))
    return np.frombuffer(text, np.uint8)[~gone].tobytes(), list(zip(turns[::2].tolist(), turns[1::2].tolist(), strict=True))


def _finish(id_at: int, text_at: int, key: str, docs: pa.Table, covers: pa.Table) -> pa.Table:
    doc, lo, hi = gathered(covers["blob"].to_pylist(), *COVERS)
    order = doc.argsort(kind="stable")
    doc, lo, hi = doc[order], lo[order], hi[order]
    ids, left, spans = docs.column(id_at).to_pylist(), [], []
    for i, text in zip(ids, docs.column(text_at).cast(pa.binary()).to_pylist(), strict=True):
        text, runs = text or b"", []
        a, b = np.searchsorted(doc, [i, i + 1]) if i is not None else (0, 0)
        if b > a and len(text) >= SPAN:
            base = tag(text) << TAGGED
            own = (hi[a:b] > base) & (lo[a:b] < base + len(text))  # of rows that share an id each has its own
            text, runs = cut_out(text, lo[a:b][own] - base, hi[a:b][own] - base)
        left.append(text)
        spans.append(runs)
    kind = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))
    runs = pa.array([[{"lo": a, "hi": b} for a, b in x] for x in spans], kind)
    release()
    return docs.drop_columns([key]).append_column("kept", pa.array(left, pa.binary())).append_column("removed", runs)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """``docs`` with kept (the bytes left, binary) and removed (array of runs lo, hi of the input's bytes)."""
    few_rows(docs.sparkSession)
    named = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    total = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = int(total // GROUP) | 1  # odd, so that strides in ids don't gather
    met = named.mapInArrow(partial(_map, groups, groups), ROWS).groupBy("key").applyInArrow(partial(_meet, groups, hot), ROWS)
    met = stored(met, "anchors")
    packed = named.mapInArrow(partial(_pack_texts, groups), ROWS)
    asked = met.where(F.col("kind") == EDGES)
    fetched = packed.groupBy("key").cogroup(asked.groupBy("key")).applyInArrow(partial(_fetch, groups, groups), ROWS)
    sorted_out = stored(fetched.groupBy("key").applyInArrow(partial(_sort, groups), ROWS), "covers")
    covers = met.where(F.col("kind") == COVER).union(sorted_out)
    docs, key = docs.drop("kept", "removed"), "__key"
    while key in docs.columns:
        key += "_"
    own = F.crc32(F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))).bitwiseAND(F.lit(TAGS))
    group = F.pmod(F.coalesce(F.pmod(F.col(id_col).cast("long"), F.lit(groups)), F.lit(0)) + own, F.lit(groups))
    run = T.StructType([T.StructField("lo", T.LongType()), T.StructField("hi", T.LongType())])
    schema = T.StructType([*docs.schema.fields, T.StructField("kept", T.BinaryType()), T.StructField("removed", T.ArrayType(run))])
    finish = partial(_finish, docs.columns.index(id_col), docs.columns.index(text_col), key)
    covers = covers.withColumnRenamed("key", key)
    return docs.withColumn(key, group.cast("int")).groupBy(key).cogroup(covers.groupBy(key)).applyInArrow(finish, schema)
