"""Toxicity by a bidirectional gated recurrent network with attention
pooling, trained in numpy.

A text's words (runs of word characters, lower-cased) become inputs from two
sides: an embedding of the word, where the training sample has it often
enough, and the mean embedding of its character trigrams.  The network reads
windows of ``WINDOW`` words, one every ``STRIDE``, over the whole text; the
score of a text is that of its highest window.

Training fits on at most ``TRAIN_TOXIC`` + ``TRAIN_CLEAN`` labelled rows
that exist (those of least hash of doc_id; of rows that repeat a doc_id the least text),
whole texts, on the driver: the bound is the same at every size.  First all windows carry their text's label, then
only the highest one does.  Nothing but text enters a score.

Defined results: a null text is empty; a text without words is scored as one
empty window; without any usable label the score is 0.0; rows with a null
doc_id are never trained on and have ``held_out`` false; labels that repeat
a doc_id count as toxic if one of them is; repeated rows are scored row by
row; an empty table gives no rows; columns other than those named are
ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe_vocab import on_worker, slices

WINDOW, STRIDE = 32, 16
HIDDEN, WORD_DIM, CHAR_DIM, ATTENTION = 8, 8, 8, 8
VOCABULARY, LEAST_TEXTS = 20_000, 3
GRAM_BITS = 13
TRAIN_TOXIC, TRAIN_CLEAN = 600, 1400
ALL_WINDOWS_STEPS, HIGHEST_STEPS, RATE = 100, 60, 0.01      # at least, in whole rounds over the rows
LEAST_BATCH, BATCH = 32, 256
DECAY = 1.0
KNOWN_WORDS = 100_000     # words whose inputs a worker keeps

words_of = re.compile(r"\w+").findall


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


# ------------------------------------------------------------------ inputs
def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character trigrams of words (with marks at both ends): all of
    them side by side, and where each word's begin."""
    text = "".join([f"\x02{w}\x03" for w in words])
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint32)
    h = codes[:-2] * np.uint32(0x9E3779B1) + codes[1:-1] * np.uint32(0x85EBCA77) + codes[2:] * np.uint32(0xC2B2AE3D)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    ids = (h >> np.uint32(32 - GRAM_BITS)).astype(np.int64)
    sizes = np.array([len(w) for w in words])               # trigrams of a marked word: its length
    starts = np.cumsum(sizes + 2) - (sizes + 2)
    first = np.cumsum(sizes) - sizes
    at = np.arange(sizes.sum()) + np.repeat(starts - first, sizes)
    return ids[at], first


def windows(n: int) -> list[int]:
    """First words of a text's windows."""
    return [0] if n <= WINDOW else [*range(0, n - WINDOW, STRIDE), n - WINDOW]


# ------------------------------------------------------------------ network
def start(vocabulary: int, rng: np.random.Generator) -> dict[str, np.ndarray]:
    def normal(*shape, scale):
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    d, h = WORD_DIM + CHAR_DIM, HIDDEN
    return {
        "word": normal(vocabulary + 1, WORD_DIM, scale=0.1), "char": normal(1 << GRAM_BITS, CHAR_DIM, scale=0.1),
        "wx": normal(2, d, 3 * h, scale=d ** -0.5), "u": normal(2, h, 3 * h, scale=h ** -0.5),
        "b": np.zeros((2, 3 * h), np.float32), "wa": normal(2 * h, ATTENTION, scale=h ** -0.5),
        "va": normal(ATTENTION, scale=0.5), "wo": normal(2 * h, scale=0.5), "bo": np.zeros(1, np.float32)}


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def gate_inputs(p: dict, word: np.ndarray, gram: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Embedded inputs of words and what they add to the gates, for both
    directions."""
    sizes = np.diff(np.append(first, len(gram)))
    x = np.concatenate([p["word"][word], np.add.reduceat(p["char"][gram], first, axis=0) / sizes[:, None]], axis=1)
    return x, np.concatenate([x @ p["wx"][k] + p["b"][k] for k in (0, 1)], axis=1)


def forward(p: dict, gates: np.ndarray, at: np.ndarray, mask: np.ndarray, keep: bool = False):
    """Logits of windows; ``at`` (windows, steps) are rows of ``gates``."""
    n, steps = at.shape
    h3 = 3 * HIDDEN
    states = np.zeros((steps, n, 2 * HIDDEN), np.float32)
    saved: list = [[None] * steps, [None] * steps]
    for k in (0, 1):
        s = np.zeros((n, HIDDEN), np.float32)
        u = p["u"][k]
        for t in range(steps) if k == 0 else range(steps - 1, -1, -1):
            g = gates[at[:, t], k * h3:(k + 1) * h3]
            r = s @ u
            zr = sigmoid(g[:, :2 * HIDDEN] + r[:, :2 * HIDDEN])
            z, reset = zr[:, :HIDDEN], zr[:, HIDDEN:]
            c = np.tanh(g[:, 2 * HIDDEN:] + reset * r[:, 2 * HIDDEN:])
            m = mask[:, t, None]
            new = s + m * z * (c - s)
            if keep:
                saved[k][t] = (s, z, reset, c, r[:, 2 * HIDDEN:], m)
            s = new
            states[t, :, k * HIDDEN:(k + 1) * HIDDEN] = s
    a = np.tanh(states @ p["wa"])
    e = a @ p["va"] + (mask.T - 1) * 1e4
    w = np.exp(e - e.max(0))
    w /= w.sum(0)
    pooled = (w[:, :, None] * states).sum(0)
    logit = pooled @ p["wo"] + p["bo"][0]
    return (logit, (states, saved, a, w, pooled)) if keep else logit


def backward(p: dict, at: np.ndarray, mask: np.ndarray, kept, d_logit: np.ndarray, n_rows: int):
    """Gradients of the parameters behind ``gates``, and of ``gates``."""
    states, saved, a, w, pooled = kept
    steps = at.shape[1]
    g = {"wo": pooled.T @ d_logit, "bo": d_logit.sum(keepdims=True)}
    d_pooled = d_logit[:, None] * p["wo"]
    d_states = w[:, :, None] * d_pooled
    d_w = (states * d_pooled).sum(2)
    d_e = w * (d_w - (w * d_w).sum(0))
    g["va"] = (a * d_e[:, :, None]).sum((0, 1))
    d_a = d_e[:, :, None] * p["va"] * (1 - a * a)
    g["wa"] = np.tensordot(states, d_a, ((0, 1), (0, 1)))
    d_states += d_a @ p["wa"].T
    g["u"] = np.zeros_like(p["u"])
    h3 = 3 * HIDDEN
    d_gates = np.zeros((n_rows, 2 * h3), np.float32)
    for k in (0, 1):
        u, carry = p["u"][k], 0.0
        for t in range(steps - 1, -1, -1) if k == 0 else range(steps):
            s, z, reset, c, rc, m = saved[k][t]
            d = d_states[t, :, k * HIDDEN:(k + 1) * HIDDEN] + carry
            dm = d * m
            d_c = dm * z * (1 - c * c)
            d_z = dm * (c - s) * z * (1 - z)
            d_r = d_c * rc * reset * (1 - reset)
            d_in = np.concatenate([d_z, d_r, d_c], 1)
            d_rec = np.concatenate([d_z, d_r, d_c * reset], 1)
            g["u"][k] += s.T @ d_rec
            carry = d - dm * z + d_rec @ u.T
            np.add.at(d_gates, (at[:, t], slice(k * h3, (k + 1) * h3)), d_in)
    return g, d_gates


# ------------------------------------------------------------------ training
def train(texts: list[str], toxic: list[int], seed: int = 0) -> dict[str, Any] | None:
    """A model from whole texts and their labels."""
    if not texts:
        return None
    rng = np.random.default_rng(seed)
    split = [words_of((t or "").lower()) for t in texts]
    seen = Counter(w for ws in split for w in set(ws))
    vocabulary = {w: i + 1 for i, (w, _) in enumerate(sorted(
        ((w, c) for w, c in seen.items() if c >= LEAST_TEXTS), key=lambda x: (-x[1], x[0]))[:VOCABULARY])}
    words = ["", *seen]
    row = {w: i for i, w in enumerate(words)}
    word = np.array([vocabulary.get(w, 0) for w in words])
    gram, first = grams([w or "\x00" for w in words])
    ends = np.append(first[1:], len(gram))

    at, mask, text = [], [], []
    for i, ws in enumerate(split):
        rows = np.array([row[w] for w in ws], np.int64)
        for a in windows(len(ws)):
            r = rows[a:a + WINDOW]
            at.append(np.pad(r, (0, WINDOW - len(r))))
            mask.append(np.arange(WINDOW) < max(1, len(r)))
            text.append(i)
    at, mask, text = np.array(at), np.array(mask, np.float32), np.array(text)
    y = np.array(toxic, np.float32)
    positive = y.mean()
    weight = np.where(y > 0, 0.5 / max(positive, 1e-3), 0.5 / max(1 - positive, 1e-3)).astype(np.float32)

    p = start(len(vocabulary), rng)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
    step = 0

    def learn(chosen: np.ndarray) -> None:
        nonlocal step
        rows, back = np.unique(at[chosen], return_inverse=True)
        back = back.reshape(len(chosen), WINDOW)
        sizes = ends[rows] - first[rows]
        starts = np.cumsum(sizes) - sizes
        own = gram[np.arange(sizes.sum()) + np.repeat(first[rows] - starts, sizes)]
        x, gates = gate_inputs(p, word[rows], own, starts)
        m, label = mask[chosen], y[text[chosen]]
        logit, kept = forward(p, gates, back, m, keep=True)
        d = ((sigmoid(logit) - label) * weight[text[chosen]] / len(chosen)).astype(np.float32)
        g, d_gates = backward(p, back, m, kept, d, len(rows))
        h3 = 3 * HIDDEN
        halves = [d_gates[:, k * h3:(k + 1) * h3] for k in (0, 1)]
        g["wx"] = np.stack([x.T @ half for half in halves])
        g["b"] = np.stack([half.sum(0) for half in halves])
        d_x = sum(half @ p["wx"][k].T for k, half in enumerate(halves))
        g["word"], g["char"] = np.zeros_like(p["word"]), np.zeros_like(p["char"])
        np.add.at(g["word"], word[rows], d_x[:, :WORD_DIM])
        np.add.at(g["char"], own, np.repeat(d_x[:, WORD_DIM:] / sizes[:, None], sizes, axis=0))
        step += 1
        for k, v in p.items():     # Adam
            m1, m2 = moments[k]
            m1 += 0.1 * (g[k] - m1)
            m2 += 0.001 * (g[k] ** 2 - m2)
            v -= RATE * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.999 ** step)) + 1e-8)
            if k in ("word", "char"):       # rare words should not be learned by heart
                v *= np.float32(1 - RATE * DECAY)

    def highest() -> np.ndarray:
        _, gates = gate_inputs(p, word, gram, first)
        logit = np.concatenate([forward(p, gates, at[a:a + 4096], mask[a:a + 4096]) for a in range(0, len(at), 4096)])
        order = np.lexsort((logit, text))
        return order[np.append(np.flatnonzero(np.diff(text[order])), len(order) - 1)]

    batch = int(np.clip(len(texts) // 8, LEAST_BATCH, BATCH))
    while step < ALL_WINDOWS_STEPS + HIGHEST_STEPS:
        if step < ALL_WINDOWS_STEPS:        # as many windows as texts, drawn anew: long texts do not outweigh others
            order = rng.permutation(len(at))
            _, one = np.unique(text[order], return_index=True)
            pool = np.concatenate([order[one], rng.choice(len(at), min(len(at), 3 * len(texts)), replace=False)])
        else:
            pool = highest()
        pool = rng.permutation(pool)
        for a in range(0, len(pool), batch):
            learn(pool[a:a + batch])
    return {"p": p, "vocabulary": vocabulary}


def training_rows(docs: DataFrame, labels: DataFrame, toxic: int, most: int) -> DataFrame:
    ids = (labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
           .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
           .filter(~held_out(F.col("doc_id")) & (F.col("toxic") == toxic))
           .join(docs.select("doc_id"), "doc_id", "left_semi")      # ids without a row do not use up the sample
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    # at most ``most`` ids
    return (docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
            .groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")))


def fit(docs: DataFrame, labels: DataFrame) -> dict[str, Any] | None:
    rows = (training_rows(docs, labels, 1, TRAIN_TOXIC).unionByName(training_rows(docs, labels, 0, TRAIN_CLEAN))
            .collect())
    rows = sorted(rows, key=lambda r: (r["doc_id"], r["text"] or ""))
    return train([r["text"] for r in rows], [r["toxic"] for r in rows])


# ------------------------------------------------------------------ scoring
class Scorer:
    """Scores texts; keeps the gate inputs of the words it has met."""

    def __init__(self, model: dict[str, Any]):
        self.p, self.vocabulary = model["p"], model["vocabulary"]
        self._forget()

    def _forget(self) -> None:
        self.rows: dict[str, int] = {}
        self.gates = np.zeros((KNOWN_WORDS, 6 * HIDDEN), np.float32)
        self._add([""])

    def _add(self, words: list[str]) -> None:
        new = [w for w in dict.fromkeys(words) if w not in self.rows]
        if not new:
            return
        gram, first = grams([w or "\x00" for w in new])
        _, gates = gate_inputs(self.p, np.array([self.vocabulary.get(w, 0) for w in new]), gram, first)
        known, end = len(self.rows), len(self.rows) + len(new)
        if end > len(self.gates):       # by one group's words at most: scores() forgets before the next
            self.gates = np.concatenate([self.gates[:known], np.zeros((len(new), 6 * HIDDEN), np.float32)])
        self.gates[known:end] = gates
        self.rows.update(zip(new, range(known, end)))

    def scores(self, texts: list[str]) -> np.ndarray:
        if len(self.rows) > KNOWN_WORDS:
            self._forget()
        split = [words_of((t or "").lower()) for t in texts]
        self._add([w for ws in split for w in ws])
        index, masks, counts = [], [], []
        steps, row = np.arange(WINDOW), self.rows.__getitem__
        for ws in split:
            rows = np.fromiter(map(row, ws), np.int64, len(ws))
            a = np.array(windows(len(ws)))
            at = a[:, None] + steps
            ok = at < max(1, len(ws))
            index.append(np.where(ok, rows[np.minimum(at, len(ws) - 1)], 0) if len(ws) else np.zeros((1, WINDOW), np.int64))
            masks.append(ok)
            counts.append(len(a))
        index, mask = np.concatenate(index), np.concatenate(masks).astype(np.float32)
        logits = np.concatenate([forward(self.p, self.gates, index[a:a + 2048], mask[a:a + 2048])
                                 for a in range(0, len(index), 2048)])
        first = np.cumsum(counts) - counts
        return sigmoid(np.maximum.reduceat(logits, first).astype(np.float64))


def _groups(texts: list[str | None], most: int = 1 << 18) -> Iterator[list[str]]:
    """Texts in groups of about ``most`` code points."""
    group, held = [], 0
    for t in texts:
        group.append(t or "")
        held += len(t or "")
        if held >= most:
            yield group
            group, held = [], 0
    if group:
        yield group


def score(docs: DataFrame, model: dict[str, Any] | None) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if model is None:
        scored = src.select("doc_id", F.lit(0.0).alias("score"))
    else:
        shared = docs.sparkSession.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            scorer = on_worker("toxicity", shared, Scorer)
            for batch in batches:
                done = [scorer.scores(g) for part in slices(batch) for g in _groups(part.column("text").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(np.concatenate([np.zeros(0), *done]))], ["doc_id", "score"])

        scored = src.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: dict[str, Any] | None) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their
    columns; one pass, without a shuffle."""
    if model is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = on_worker("toxicity", shared, Scorer)
        for batch in batches:
            for part in slices(batch):
                done = [scorer.scores(g) for g in _groups(part.column("text").to_pylist())]
                yield part.filter(pa.array(np.concatenate([np.zeros(0), *done]) < 0.5))

    return docs.mapInArrow(run, docs.schema)
