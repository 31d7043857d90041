"""Language ID by a bidirectional gated recurrent network over bytes, trained in numpy.

A text's UTF-8 bytes are cut into windows of ``WINDOW`` bytes that cover all of it. Over each window one network reads
forwards and one backwards; from both states every position gets a probability for each language, and a document's
probabilities are the means over all its positions. Training is by backpropagation through time with Adam on windows
from at most ``per_language`` documents of each language, drawn by a hash of the id.

Defined cases: texts that are null or hold no letter are ``und`` with score 0; where nothing can be learned (an empty
table, no label) every text is ``und``; a null id is not held out and not learned from; repeated rows each get a row;
an empty table gives an empty result; input columns named like an output are replaced.
"""

from __future__ import annotations

import re
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.common import few_rows, lean, slices

WINDOW, HIDDEN = 64, 8
#: Sample: documents of a language, windows of each, languages (the most frequent).
PER_LANGUAGE, WINDOWS, MOST_LANGUAGES = 400, 4, 200
STEPS, BATCH, RATE, SEED = 220, 192, 0.015, 11
LANES = 2048
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")


def sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


class Network:
    """Arrays by name: e (byte and direction -> gates), u (state -> gates), w and b (both states -> languages)."""

    def __init__(self, languages: int, seed: int = SEED, hidden: int = HIDDEN):
        rng, h = np.random.default_rng(seed), hidden
        draw = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
        self.a = {"e": draw(512, 3 * h), "u": draw(2, h, 3 * h), "w": draw(2 * h, languages), "b": np.zeros(languages, np.float32)}

    def states(self, x: np.ndarray, keep: list | None = None) -> np.ndarray:
        """(positions, windows, 2 * hidden) of windows ``x`` (windows, positions) of bytes."""
        e, u = self.a["e"], self.a["u"]
        n, length, h = *x.shape, u.shape[1]
        at = np.stack([x.T, x.T[::-1].astype(np.int32) + 256], axis=1).astype(np.int32)
        state, out = np.zeros((2, n, h), np.float32), np.empty((length, n, 2 * h), np.float32)
        for t in range(length):
            put, got = e[at[t]], state @ u
            gates = sigmoid(put[..., : 2 * h] + got[..., : 2 * h])
            hold, reset = gates[..., :h], gates[..., h:]
            fresh = reset * got[..., 2 * h :]
            fresh += put[..., 2 * h :]
            np.tanh(fresh, out=fresh)
            if keep is not None:
                keep.append((at[t], state, hold, reset, fresh, got[..., 2 * h :]))
            state = fresh + hold * (state - fresh)
            out[t, :, :h] = state[0]
            out[length - 1 - t, :, h:] = state[1]
        return out

    def probabilities(self, states: np.ndarray) -> np.ndarray:
        logits = states @ self.a["w"] + self.a["b"]
        logits -= logits.max(-1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(-1, keepdims=True)
        return logits

    def gradients(self, x: np.ndarray, lengths: np.ndarray, y: np.ndarray) -> dict:
        """Backpropagation through time of the mean cross-entropy over all positions."""
        keep: list = []
        states = self.states(x, keep)
        length, n, h = states.shape[0], states.shape[1], states.shape[2] // 2
        d = self.probabilities(states)
        d[:, np.arange(n), y] -= 1
        d *= (np.arange(length)[:, None] < lengths)[..., None] / max(1, lengths.sum())
        d = d.astype(np.float32)
        g = {"w": np.tensordot(states, d, ((0, 1), (0, 1))), "b": d.sum((0, 1)), "e": np.zeros_like(self.a["e"]), "u": np.zeros_like(self.a["u"])}
        back, u = d @ self.a["w"].T, self.a["u"]
        flow = np.zeros((2, n, h), np.float32)
        for t in range(length - 1, -1, -1):
            at, before, hold, reset, fresh, got = keep[t]
            flow = flow + np.stack([back[t, :, :h], back[length - 1 - t, :, h:]])
            d_fresh = flow * (1 - hold) * (1 - fresh * fresh)
            d_hold = flow * (before - fresh) * hold * (1 - hold)
            d_reset = d_fresh * got * reset * (1 - reset)
            put = np.concatenate([d_hold, d_reset, d_fresh], -1)
            through = np.concatenate([d_hold, d_reset, d_fresh * reset], -1)
            np.add.at(g["e"], at, put)
            g["u"] += before.transpose(0, 2, 1) @ through
            flow = flow * hold + through @ u.transpose(0, 2, 1)
        return g


def windows_of(texts: list[bytes], size: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows that cover the texts, the bytes in each, and the text of each."""
    n = np.array([-(-len(t) // size) for t in texts], np.int64)
    x = np.frombuffer(b"".join(t.ljust(k * size, b"\0") for t, k in zip(texts, n.tolist(), strict=True)), np.uint8).reshape(-1, size)
    owner = np.repeat(np.arange(len(texts)), n)
    last = np.cumsum(n)[n > 0] - 1
    lengths = np.full(len(x), size)
    lengths[last] = [(len(t) - 1) % size + 1 for t in texts if t]
    return x, lengths, owner


def train(texts: list[bytes], labels: list[int], languages: int, steps: int = STEPS) -> Network:
    net, rng = Network(languages), np.random.default_rng(SEED)
    y = np.array(labels)
    x, lengths, owner = windows_of([t[:WINDOW] for t in texts])
    y = y[owner]
    weight = 1 / np.bincount(y, minlength=languages)[y]
    weight = weight / weight.sum()
    m = {k: np.zeros_like(v) for k, v in net.a.items()}
    s = {k: np.zeros_like(v) for k, v in net.a.items()}
    for step in range(1, steps + 1):
        pick = rng.choice(len(x), BATCH, p=weight)
        rate = RATE * min(1, 2 * (1 - step / (steps + 1)))
        for k, g in net.gradients(x[pick], lengths[pick], y[pick]).items():
            m[k] += 0.1 * (g - m[k])
            s[k] += 0.01 * (g * g - s[k])
            net.a[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def pooled(net: Network, texts: list[bytes]) -> np.ndarray:
    """Mean probabilities over all positions of each text."""
    x, lengths, owner = windows_of(texts)
    sums, most = np.zeros((len(texts), len(net.a["b"]))), np.arange(WINDOW)[:, None]
    for lo in range(0, len(x), LANES):
        p = net.probabilities(net.states(x[lo : lo + LANES]))
        p *= (most < lengths[lo : lo + LANES])[..., None]
        part, own = p.sum(0), owner[lo : lo + LANES]
        starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        sums[own[starts]] += np.add.reduceat(part, starts, axis=0)
    return sums / np.maximum(1, np.array([len(t) for t in texts]))[:, None]


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, id_col: str, text_col: str, lang_col: str, most_languages: int = MOST_LANGUAGES) -> tuple[Network | None, list[str]]:
    """The network and its languages, from a bounded sample of the labelled rows that are not held out."""
    labelled = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    labelled = labelled.where(F.col("id").isNotNull() & ~held_out(F.col("id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = labelled.select("lang").groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_languages).collect()  # at most so many
    names = sorted(r["lang"] for r in counts)
    if not names:
        return None, []
    drawn = F.xxhash64(F.col("id").cast("string"), F.lit(SEED))
    share = F.create_map(*(x for r in counts for x in (F.lit(r["lang"]), F.lit(min(1.0, 2.0 * PER_LANGUAGE / r["count"])))))
    thin = labelled.withColumn("h", drawn).where(F.pmod("h", F.lit(1 << 20)) < F.element_at(share, F.col("lang")) * (1 << 20))
    rank = F.row_number().over(W.partitionBy("lang").orderBy("h", "id", "starts"))
    room = F.greatest(F.char_length("text") - WINDOW, F.lit(0)) + 1
    spread = [(F.pmod(F.xxhash64("h", F.lit(k)), room) + 1).cast("int") for k in range(WINDOWS)]
    cut = F.array(*(F.substring(F.col("text"), p, F.lit(WINDOW)) for p in spread))
    sample = thin.select("lang", "h", "id", cut.alias("starts")).withColumn("r", rank).where(F.col("r") <= PER_LANGUAGE)
    rows = sorted(tuple(r) for r in sample.select("lang", "h", "id", "starts").collect())  # at most per language as many
    pairs = [(w.encode(), names.index(lang)) for lang, _, _, starts in rows for w in starts if w]
    if not pairs:
        return None, []
    return train([w for w, _ in pairs], [k for _, k in pairs], len(names)), names


@lean
def _predict(net, names, at, batches):
    for batch in slices(batches):
        texts = batch.column(at)
        lettered = [t is not None and bool(LETTER.search(t)) for t in texts.to_pylist()]
        lang, score = [UNKNOWN] * len(lettered), np.zeros(len(lettered))
        where = np.flatnonzero(lettered)
        if net is not None and len(where):
            found = pooled(net, texts.take(pa.array(where)).cast(pa.binary()).to_pylist())
            best = found.argmax(1)
            score[where] = np.minimum(1.0, found[np.arange(len(where)), best])
            for i, k in zip(where.tolist(), best.tolist(), strict=True):
                lang[i] = names[k]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang, pa.string()), pa.array(score)], [*batch.schema.names, "lang_pred", "score"])


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", most_languages: int = MOST_LANGUAGES) -> DataFrame:
    """``docs`` with held_out, lang_pred and score. The ``most_languages`` most frequent ones are learned; of equally
    probable languages the first by name is predicted."""
    few_rows(docs.sparkSession)
    net, names = learn(docs, id_col, text_col, lang_col, most_languages)
    docs = docs.drop("held_out", "lang_pred", "score")
    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    predicted = docs.mapInArrow(partial(_predict, net, names, docs.columns.index(text_col)), schema)
    return predicted.withColumn("held_out", held_out(F.col(id_col)))
