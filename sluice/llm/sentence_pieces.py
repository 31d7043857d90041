"""SentencePiece encoding and decoding as a weighted finite-state transduction.

Two transducers are compiled from a model file: the normaliser (a blank in front, blanks and marks to one symbol,
superfluous ones to nothing; states for the start, for text and for a blank that waits) and the lexicon (a trie of the
pieces that emits a piece at its end and goes back to the root; a character outside it goes to the bytes of its UTF-8
form). The normaliser is deterministic, so composed with an input it leaves one string of symbols; composed with the
lexicon that gives the lattice of its segmentations, whose shortest path in the tropical semiring (sums along a path,
least over paths) is the encoding.

For unigram models an arc weighs its piece's negative score. A BPE model's scores are merge ranks that don't add up
along a path; its weights are on pairs of neighbouring pieces instead: 0 if merging the two pieces' characters gives
these two pieces back, else infinite. A segmentation is the BPE encoding exactly if all its pairs weigh 0, and each
prefix has one such path, so the lattice has one live state at a position. Paths weigh 0 or infinite, so the first one
to the end without an infinite arc is the shortest: it is searched depth first, longest pieces first, and enters few
positions, none twice.

No piece crosses the end of a word (a mark after another character) or a character that no longer piece holds, so all
paths pass there: the lattice is cut at these places and each different part is solved once and kept. What is kept is
bounded (``KEPT`` parts and ``PAIRS`` pairs in two generations), as it stays in a worker's memory.

Defined cases: null and empty texts have no tokens and decode to an empty text; texts of any length are taken whole
(a very long word is one lattice, of steps in proportion); repeated rows each get a row; an empty table gives an empty
result; input columns named like an output are replaced. U+2581 in a text decodes to a blank, as it does in the
library.
"""

from __future__ import annotations

import hashlib
import re
import struct
from array import array
from functools import lru_cache, partial
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sluice.llm.common import few_rows, lean, slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, DEFINED, UNUSED, BYTE = range(1, 7)
UNIGRAM, BPE = 1, 2
KEPT, LONGEST_KEPT, PAIRS = 150_000, 48, 400_000
NONE = float("-inf")


# ---------------------------------------------------------------- model file
def fields(raw: bytes):
    """(number, value) of a protocol buffer's fields: ints, floats (of 4 bytes) and bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(raw):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        elif kind == 5:
            yield tag >> 3, struct.unpack_from("<f", raw, at)[0]
            at += 4
        elif kind == 1:
            yield tag >> 3, raw[at : at + 8]
            at += 8
        else:
            n = varint()
            yield tag >> 3, raw[at : at + n]
            at += n


class Normaliser:
    """A deterministic transducer on two kinds of symbols: blanks (and marks) and others.

    ``arcs`` has, by state and kind, the next state and what is written before the symbol, and whether the symbol
    itself is written. START is where nothing is written yet, WAITING where a blank is held back."""

    START, TEXT, WAITING = range(3)

    def __init__(self, dummy: bool, squeeze: bool):
        front = " " if dummy else ""
        blank, other = True, False
        self.arcs = {
            (self.START, other): (self.TEXT, front, True),
            (self.START, blank): (self.START, "", False) if squeeze else (self.TEXT, front, True),
            (self.TEXT, other): (self.TEXT, "", True),
            (self.TEXT, blank): (self.WAITING, "", False) if squeeze else (self.TEXT, "", True),
            (self.WAITING, other): (self.TEXT, " ", True),
            (self.WAITING, blank): (self.WAITING, "", False),
        }
        # Where a state's arcs all lead back to it and write the symbol, what is left of a text is copied at once.
        self.copies = {s for s in range(3) if all(self.arcs[s, k] == (s, "", True) for k in (blank, other))}
        self.runs = re.compile("[^ ]+| ")

    def compose(self, text: str) -> str:
        """The one output for an input; every state is final, a blank held back at the end is not written."""
        text, state, at, out = text.replace(MARK, " "), self.START, 0, []
        while at < len(text):
            if state in self.copies:
                out.append(text[at:])
                break
            end = self.runs.match(text, at).end()
            state, before, kept = self.arcs[state, text[at] == " "]
            out.append(before + text[at:end] if kept else before)
            at = end
        return "".join(out)


class Transducer:
    def __init__(self, raw: bytes):
        pieces, kind, self.dummy, self.squeeze, charsmap = [], UNIGRAM, True, True, b""
        for number, value in fields(raw):
            if number == 1:
                piece = {1: b"", 2: 0.0, 3: NORMAL} | dict(fields(value))
                pieces.append((piece[1].decode(), piece[2], piece[3]))
            elif number == 2:
                kind = dict(fields(value)).get(3, UNIGRAM)
            elif number == 3:
                spec = dict(fields(value))
                charsmap, self.dummy, self.squeeze = spec.get(2, b""), bool(spec.get(3, 1)), bool(spec.get(4, 1))
        self.normaliser = Normaliser(self.dummy, self.squeeze)
        if charsmap or kind not in (UNIGRAM, BPE):
            raise ValueError("models with a character map, and of kinds other than unigram and BPE, aren't supported")
        self.kind, self.pieces = kind, [p.replace(MARK, " ") for p, _, _ in pieces]
        self.scores, self.kinds = [s for _, s, _ in pieces], [k for _, _, k in pieces]
        self.bytes_at = {int(p[3:5], 16): i for i, (p, _, k) in enumerate(pieces) if k == BYTE}
        self.unknown = next((i for i, k in enumerate(self.kinds) if k == UNKNOWN), 0)
        usable = {p: i for i, p in enumerate(self.pieces) if self.kinds[i] in (NORMAL, DEFINED)}
        self.ids = usable
        self.ranks = {p: self.scores[i] for p, i in usable.items()}
        self.trie: dict[str, list] = {}  # by character: the piece that ends there or None, and the node below
        for p, i in usable.items():
            below = self.trie
            for c in p:
                arc = below.setdefault(c, [None, {}])
                below = arc[1]
            if p:
                arc[0] = i
        self.shorter: list[int | None] = [None] * len(pieces)  # a piece's longest beginning that is a piece
        for p, i in usable.items():
            below = self.trie
            for c in p[:-1]:
                ends, below = below[c]
                self.shorter[i] = self.shorter[i] if ends is None else ends
        if any(" " in p.lstrip(" ") for p in usable):
            raise ValueError("pieces that go on after a word's end aren't supported")
        joint = "".join(sorted({c for p in usable if len(p) > 1 for c in p} - {" "}))
        joint = f"[{re.escape(joint)}]" if joint else r"(?!)."
        self.part = re.compile(rf" *{joint}+| +|.", re.DOTALL)
        self.worst = min((s for s, k in zip(self.scores, self.kinds, strict=True) if k == NORMAL), default=0.0) - 10
        self.pairs: dict[int, bool] = {}
        self.kept: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.surface = [self._surface(i) for i in range(len(pieces))]

    # ------------------------------------------------------------ weights
    def merged(self, text: str) -> list[str]:
        """The pieces that merging by rank makes of a short text (the leftmost of equal ranks first)."""
        parts, rank = list(text), self.ranks.get
        ranks = [rank(a + b, NONE) for a, b in pairwise(parts)]
        while ranks and (best := max(ranks)) != NONE:
            i = ranks.index(best)
            parts[i] += parts.pop(i + 1)
            del ranks[i]
            if i:
                ranks[i - 1] = rank(parts[i - 1] + parts[i], NONE)
            if i < len(ranks):
                ranks[i] = rank(parts[i] + parts[i + 1], NONE)
        return parts

    def fits(self, a: int, b: int) -> bool:
        """Whether the pair weighs 0. A negative piece stands for the start or a character of its own."""
        key = a << 32 | b
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            p, q = self.pieces[a] if a >= 0 else "", self.pieces[b]
            known = self.pairs[key] = self.merged(p + q) == ([p, q] if p else [q])
        return known

    # ------------------------------------------------------------ shortest paths
    def free_path(self, part: str) -> list[int] | None:
        """The path of weight 0 through a BPE model's lattice, or None if there is none (a character is no piece)."""
        n, trie, pairs, shorter, out, here, i = len(part), self.trie, self.pairs, self.shorter, [], -1, 0
        while i < n:
            below, k, at = trie, None, i
            while at < n and (arc := below.get(part[at])) is not None:
                at += 1
                ends, below = arc
                if ends is not None:
                    k = ends
            while True:
                while k is not None and not (self.fits(here, k) if (known := pairs.get(here << 32 | k)) is None else known):
                    k = shorter[k]
                if k is not None:
                    break
                if not out:
                    return None
                last = out.pop()  # no piece goes on from here
                i -= len(self.pieces[last])
                here, k = out[-1] if out else -1, shorter[last]
            out.append(k)
            i += len(self.pieces[k])
            here = k
        return out

    def path(self, part: str) -> list[int]:
        """Shortest path through the lattice of a part."""
        n, bpe = len(part), self.kind == BPE
        if bpe and (free := self.free_path(part)) is not None:
            return free
        cost, last, back = [None] * n + [None], [-1] * (n + 1), [0] * (n + 1)
        cost[0] = 0.0
        for j in range(n):
            if cost[j] is None:
                continue
            below, i, here = self.trie, j, last[j]
            while i < n and (arc := below.get(part[i])) is not None:
                i += 1
                k, below = arc
                if k is None:
                    continue
                if bpe:
                    if cost[i] is None and (self.pairs.get(here << 32 | k) or self.fits(here, k)):
                        cost[i], last[i], back[i] = 0.0, k, j
                elif cost[i] is None or cost[j] - self.scores[k] < cost[i]:
                    cost[i], last[i], back[i] = cost[j] - self.scores[k], k, j
            if part[j] not in self.ids and (cost[j + 1] is None or not bpe and cost[j] - self.worst < cost[j + 1]):
                cost[j + 1], last[j + 1], back[j + 1] = cost[j] - self.worst, -2, j
        out, i = [], n
        while i:
            j = back[i]
            out.append([last[i]] if last[i] >= 0 else self.fallback(part[j:i]))
            i = j
        return [k for ids in reversed(out) for k in ids]

    def fallback(self, character: str) -> list[int]:
        return [self.bytes_at[b] for b in character.encode()] if self.bytes_at else [self.unknown]

    def encode(self, text: str) -> np.ndarray:
        parts, kept = self.part.findall(self.normaliser.compose(text)), self.kept
        found = list(map(kept.get, parts))
        new = [i for i, ids in enumerate(found) if ids is None]
        if not new:
            return np.frombuffer(b"".join(found), np.int32)
        solved, old = {}, self.older
        for i in new:
            p = parts[i]
            ids = solved.get(p)
            if ids is None:
                ids = old.get(p)
                solved[p] = ids = array("i", self.path(p)).tobytes() if ids is None else ids
            found[i] = ids
        out = b"".join(found)
        if len(kept) > KEPT:  # what is used goes on into the next generation
            self.older, self.kept = kept, {}
        self.kept.update(x for x in solved.items() if len(x[0]) <= LONGEST_KEPT)
        return np.frombuffer(out, np.int32)

    # ------------------------------------------------------------ decoding
    def _surface(self, i: int) -> bytes:
        kind = self.kinds[i]
        if kind == BYTE:
            return bytes([int(self.pieces[i][3:5], 16)])
        return b"" if kind == CONTROL else " ⁇ ".encode() if kind == UNKNOWN else self.pieces[i].encode()

    def decode(self, ids: list[int]) -> bytes:
        """The text's UTF-8 bytes; bytes that make no character stay as they are."""
        raw = b"".join(map(self.surface.__getitem__, ids))
        return raw[1:] if self.dummy and raw[:1] == b" " else raw


@lru_cache(maxsize=2)
def compiled(raw: bytes) -> Transducer:
    return Transducer(raw)


@lean
def _encode(model: bytes, at: int, batches):
    net = compiled(model)
    for batch in slices(batches):
        texts = [t or "" for t in batch.column(at).to_pylist()]
        found = [net.encode(t) for t in texts]
        offsets = np.cumsum([0] + [len(x) for x in found])
        ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(found) if found else np.zeros(0, np.int32)))
        count = pa.array(np.diff(offsets).astype(np.int32))
        digest = pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in found], pa.string())
        again = [net.decode(x.tolist()) for x in found]
        same = pa.array([x == t.encode() for x, t in zip(again, texts, strict=True)], pa.bool_())
        decoded = pa.array([hashlib.sha256(x).hexdigest() for x in again], pa.string())
        yield pa.RecordBatch.from_arrays([*batch.columns, ids, count, digest, decoded, same], [*batch.schema.names, *OUTPUTS])


OUTPUTS = {"token_ids": T.ArrayType(T.IntegerType()), "n_tokens": T.IntegerType(), "ids_sha256": T.StringType(), "decoded_sha256": T.StringType(), "lossless": T.BooleanType()}


def encode(docs: DataFrame, text_col: str = "text", model: str = MODEL) -> DataFrame:
    """``docs`` with token_ids, n_tokens, ids_sha256 (of the ids as little-endian int32), decoded_sha256 (of the
    decoded ids' bytes) and lossless (the decoded text is the input)."""
    few_rows(docs.sparkSession)
    docs = docs.drop(*(c for c in OUTPUTS if c in docs.columns))
    raw = open(model, "rb").read()  # on the driver; executors get the bytes
    schema = T.StructType([*docs.schema.fields, *(T.StructField(k, v) for k, v in OUTPUTS.items())])
    return docs.mapInArrow(partial(_encode, raw, docs.columns.index(text_col)), schema)


@lean
def _decode(model: bytes, at: int, batches):
    net = compiled(model)
    for batch in slices(batches):
        text = pa.array([None if x is None else net.decode(x).decode("utf-8", "replace") for x in batch.column(at).to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([*batch.columns, text], [*batch.schema.names, "decoded"])


def decode(tokens: DataFrame, ids_col: str = "token_ids", model: str = MODEL) -> DataFrame:
    """``tokens`` with decoded, the text of its ids; null ids give null."""
    few_rows(tokens.sparkSession)
    tokens = tokens.drop("decoded")
    raw = open(model, "rb").read()
    schema = T.StructType([*tokens.schema.fields, T.StructField("decoded", T.StringType())])
    return tokens.mapInArrow(partial(_decode, raw, tokens.columns.index(ids_col)), schema)
