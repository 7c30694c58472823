"""Text quality by random-indexing word vectors, pooled per document, and a
two-layer network with calibrated probabilities, in numpy.

Tokens are runs of letters (bytes from 0x80 on count as such), of digits and
of other visible characters; each belongs to one of 2 ** ``WORD_BITS`` words by
hash.  A word has a fixed sparse random index vector (``NONZERO`` entries of
+-1 among ``DIMENSION``); its word vector is the sum of the index vectors of
all tokens within ``NEAR`` places of it, over all documents: workers add up
their texts, the sums of blocks of words are then added in two steps, and the
whole is of fixed size at any size of the corpus.  A document's features are
mean and spread of its tokens' word vectors, and how far these are from one
token to the next, compared with any two tokens (text that repeats its words
goes no way).

The network (``HIDDEN`` tanh units, one logistic output) is fitted on at most
``TRAIN_EACH`` labelled rows of either label that exist (those of least hash of
doc_id; of rows that repeat a doc_id the least text), weighted so that each
label counts as often as among all labelled rows.  Only their features,
2 * ``DIMENSION`` + 1 numbers a row, come to the driver.  ``CALIBRATE`` in ten of
them are kept out of the fit and set the temperature that divides the output,
by least log loss.  Nothing but text enters a score.

Defined results: a null text is empty; a text without tokens has features of
zeros and is scored by them (the way between tokens, where there are fewer
than two, is taken to be the sample's mean); without any usable label the score is 0.0; rows
with a null doc_id are never trained on and have ``held_out`` false; labels
that repeat a doc_id count as good if one of them is; repeated rows are
scored row by row; an empty table gives no rows; columns other than those
named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe_vocab import on_worker
from .toxicity import held_out

WORD_BITS, DIMENSION, NONZERO, NEAR = 14, 64, 4, 2
BLOCK, SALTS = 64, 16                 # words whose sums travel together; tasks that add one block's first
HIDDEN, STEPS, BATCH, RATE, DECAY = 16, 2500, 128, 0.003, 0.05
TRAIN_EACH, CALIBRATE = 2000, 2
CHUNK_BYTES, PIECE = 4 << 20, 1 << 20  # text, tokens or bytes worked on at once

WORDS = 1 << WORD_BITS


def _kinds() -> np.ndarray:
    kind = np.full(256, 2, np.uint8)
    kind[[*range(0, 33), 127]] = 0
    kind[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
    kind[48:58] = 3
    return kind


_KIND = _kinds()
_RANDOM = np.random.default_rng(20)
_LETTER = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64)
_PLACE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def index_vectors() -> np.ndarray:
    """Per word the ``NONZERO`` entries of its index vector, as
    2 * component + (1 if negative)."""
    rng = np.random.default_rng(21)
    where = rng.random((WORDS, DIMENSION)).argsort(axis=1)[:, :NONZERO]
    return where * 2 + rng.integers(0, 2, where.shape)


# ------------------------------------------------------------------ tokens
def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words (numbers) of the texts ``data[offsets[i]:offsets[i + 1]]`` (UTF-8
    bytes) side by side, and each one's text."""
    data, offsets = data[offsets[0]:offsets[-1]], offsets - offsets[0]
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = _KIND[data]
    edge = np.ones(n, bool)
    edge[1:] = kind[1:] != kind[:-1]
    edge[offsets[offsets < n]] = True
    at = np.flatnonzero(edge)
    end = np.append(at[1:], n)
    use = kind[at] > 0
    at, end = at[use], end[use]
    word = np.empty(len(at), np.int64)
    a = 0
    while a < len(at):
        b = max(a + 1, int(np.searchsorted(end, at[a] + PIECE, "right")))
        size = end[a:b] - at[a:b]
        first = np.cumsum(size) - size
        inside = np.arange(size.sum()) - np.repeat(first, size)
        h = np.add.reduceat(_LETTER[data[inside + np.repeat(at[a:b], size)]] * _PLACE[inside & 255], first)
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        word[a:b] = (h >> np.uint64(64 - WORD_BITS)).astype(np.int64)
        a = b
    return word, np.searchsorted(offsets, at, "right") - 1


def _chunks(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bytes and offsets of texts (none null), about ``CHUNK_BYTES`` at a time."""
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + CHUNK_BYTES, "right")) - 1)
        yield data, offsets[a:b + 1]
        a = b


# ------------------------------------------------------------------ word vectors
def add_contexts(sums: np.ndarray, word: np.ndarray, text: np.ndarray, index: np.ndarray) -> None:
    """Add the index vectors of the neighbours of every token to ``sums``
    (words, 2 * DIMENSION): plus and minus entries side by side."""
    wide = sums.shape[1]
    for a in range(0, len(word), PIECE):
        for step in range(1, NEAR + 1):
            left = word[a:min(a + PIECE, len(word) - step)]
            right = word[a + step:a + step + len(left)]
            same = text[a:a + len(left)] == text[a + step:a + step + len(left)]
            left, right = left[same], right[same]
            for own, other in ((left, right), (right, left)):
                for k in range(NONZERO):
                    sums += np.bincount(own * wide + index[other, k], minlength=sums.size).reshape(sums.shape)


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of a task's texts, by block of words."""
    sums, index = np.zeros((WORDS, 2 * DIMENSION), np.int64), index_vectors()
    for batch in batches:
        for data, offsets in _chunks(batch.column("text")):
            add_contexts(sums, *tokens(data, offsets), index)
    signed = sums[:, ::2] - sums[:, 1::2]
    yield _blocks({b: signed[b * BLOCK:(b + 1) * BLOCK] for b in range(WORDS // BLOCK)})


def _blocks(sums: dict[int, np.ndarray]) -> pa.RecordBatch:
    pack = zstandard.ZstdCompressor(level=3).compress
    sums = {b: s for b, s in sums.items() if s.any()}
    return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()),
                                       pa.array([pack(s.astype(np.int64).tobytes()) for s in sums.values()], pa.binary())],
                                      ["block", "sums"])


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums by block of a partition; there are WORDS / BLOCK at most."""
    out: dict[int, np.ndarray] = {}
    for batch in batches:
        for b, blob in zip(batch.column("block").to_pylist(), batch.column("sums").to_pylist()):
            s = _unpack(blob)
            out[b] = out[b] + s if b in out else s
    yield _blocks(out)


def _unpack(blob: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.int64).reshape(BLOCK, DIMENSION)


def context_sums(docs: DataFrame) -> np.ndarray:
    """Unscaled word vectors over all texts of ``docs``: fixed in size."""
    kind = "block int, sums binary"
    own = (docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(_gather, kind)
           .withColumn("salt", F.spark_partition_id() % SALTS))
    first = own.repartition("block", "salt").select("block", "sums").mapInArrow(_add, kind)
    out = np.zeros((WORDS, DIMENSION), np.int64)
    for r in first.repartition("block").mapInArrow(_add, kind).collect():     # one row a block
        out[r["block"] * BLOCK:(r["block"] + 1) * BLOCK] += _unpack(r["sums"])
    return out


def word_vectors(sums: np.ndarray) -> np.ndarray:
    """Vectors of length one, less their mean; words that no text has are zero."""
    size = np.sqrt((sums.astype(np.float64) ** 2).sum(axis=1))
    known = size > 0
    out = np.zeros(sums.shape)
    out[known] = sums[known] / size[known, None]
    if known.any():
        out[known] -= out[known].mean(axis=0)
    return out.astype(np.float32)


# ------------------------------------------------------------------ documents
def pooled(vectors: np.ndarray, word: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """Of ``n`` texts: mean and standard deviation of the word vectors, and the
    root mean square of the way from each to the next, as a share of that
    between any two (nan for fewer than two, or if all are the same)."""
    d = vectors.shape[1]
    sums, squares, steps = np.zeros((n, d)), np.zeros((n, d)), np.zeros(n)
    piece = PIECE >> 6
    for a in range(0, len(word), piece):
        v, t = vectors[word[a:a + piece + 1]], text[a:a + piece + 1]       # and the next piece's first
        way = np.square(v[1:] - v[:-1]).sum(axis=1) * (t[1:] == t[:-1])
        v, t = v[:piece], t[:piece]
        first = np.flatnonzero(np.append(True, t[1:] != t[:-1]))
        sums[t[first]] += np.add.reduceat(v, first, axis=0)
        squares[t[first]] += np.add.reduceat(v * v, first, axis=0)
        steps += np.bincount(t[:len(way)], way, minlength=n)
    count = np.bincount(text, minlength=n)
    mean = sums / np.maximum(1, count)[:, None]
    spread = np.sqrt(np.maximum(0, squares / np.maximum(1, count)[:, None] - mean * mean))
    between = 2 * np.square(spread).sum(axis=1)
    known = (count > 1) & (between > 0)
    way = np.sqrt(np.divide(steps, np.maximum(1, count - 1) * between, out=np.full(n, np.nan), where=known))
    return np.column_stack([mean, spread, way])


def features(vectors: np.ndarray, column: pa.Array) -> np.ndarray:
    """Features of the texts of an Arrow column without nulls."""
    done = [pooled(vectors, *tokens(data, offsets), len(offsets) - 1) for data, offsets in _chunks(column)]
    return np.concatenate([np.zeros((0, 2 * vectors.shape[1] + 1)), *done])


# ------------------------------------------------------------------ network
def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def logits(p: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    return np.tanh(x @ p["w1"] + p["b1"]) @ p["w2"] + p["b2"][0]


def gradients(p: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    """Of the weighted mean log loss."""
    h = np.tanh(x @ p["w1"] + p["b1"])
    d = (sigmoid(h @ p["w2"] + p["b2"][0]) - y) * weight / weight.sum()
    dh = d[:, None] * p["w2"] * (1 - h * h)
    return {"w1": x.T @ dh, "b1": dh.sum(axis=0), "w2": h.T @ d, "b2": d.sum(keepdims=True)}


def log_loss(logit: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    return float((weight * np.logaddexp(0, np.where(y > 0, -logit, logit))).sum() / weight.sum())


def temperature(logit: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The divisor of least log loss between 1/20 and 20 (golden section on
    its logarithm; the loss is convex in its inverse)."""
    low, high, g = -np.log(20), np.log(20), (np.sqrt(5) - 1) / 2
    loss = lambda t: log_loss(logit / np.exp(t), y, weight)
    while high - low > 1e-4:
        a, b = high - g * (high - low), low + g * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def standard(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.nan_to_num((x - mean) / scale)


def train(x: np.ndarray, y: np.ndarray, weight: np.ndarray, out: np.ndarray, seed: int = 0) -> dict[str, Any] | None:
    """A model from features, labels, weights and which rows (``out``) only
    set the temperature."""
    if not len(x):
        return None
    if out.all() or not out.any():       # too few rows to keep any out
        out = np.zeros(len(x), bool)
    rng = np.random.default_rng(seed)
    mean = np.nanmean(np.append(x[~out], np.zeros((1, x.shape[1])), axis=0), axis=0)     # the zeros: no column is all nan
    scale = np.nanstd(np.append(x[~out], mean[None], axis=0), axis=0) + 1e-6
    z = standard(x, mean, scale)
    d = z.shape[1]
    p = {"w1": rng.standard_normal((d, HIDDEN)) * d ** -0.5, "b1": np.zeros(HIDDEN),
         "w2": rng.standard_normal(HIDDEN) * HIDDEN ** -0.5, "b2": np.zeros(1)}
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
    own = np.flatnonzero(~out)
    for step in range(1, STEPS + 1):
        i = rng.choice(own, min(BATCH, len(own)), replace=False)
        for k, g in gradients(p, z[i], y[i], weight[i]).items():     # Adam
            m1, m2 = moments[k]
            m1 += 0.1 * (g - m1)
            m2 += 0.001 * (g * g - m2)
            p[k] -= RATE * ((m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.999 ** step)) + 1e-8) + DECAY * p[k])
    check = out if out.any() else ~out
    return {"p": p, "mean": mean, "scale": scale, "temperature": temperature(logits(p, z[check]), y[check], weight[check])}


# ------------------------------------------------------------------ Spark
def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text, good (0 or 1), weight: at most ``TRAIN_EACH`` rows of
    either label, weighted by how many of it there are a row kept."""
    known = (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
             .groupBy("doc_id").agg(F.max((F.col("quality") >= 1).cast("int")).alias("good"))
             .filter(~held_out(F.col("doc_id"))).join(docs.select("doc_id"), "doc_id", "left_semi"))
    sizes = {r["good"]: r["n"] for r in known.groupBy("good").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = [known.filter(F.col("good") == good).orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_EACH)
             .withColumn("weight", F.lit(sizes.get(good, 0) / max(1, min(sizes.get(good, 0), TRAIN_EACH)))) for good in (0, 1)]
    ids = parts[0].unionByName(parts[1])
    # 2 * TRAIN_EACH ids at most
    return (docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
            .groupBy("doc_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"), F.max("good").alias("good"),
                                   F.max("weight").alias("weight")))


def fit(docs: DataFrame, labels: DataFrame) -> dict[str, Any] | None:
    vectors = word_vectors(context_sums(docs))
    shared = docs.sparkSession.sparkContext.broadcast(vectors)      # fixed in size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features(shared.value, batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("good"), batch.column("weight"),
                                              pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "good", "weight", "x"])

    rows = (training_rows(docs, labels).select(F.col("doc_id").cast("long").alias("doc_id"), "text", "good", "weight")
            .mapInArrow(run, "doc_id long, good int, weight double, x array<double>")
            .withColumn("out", F.pmod(F.xxhash64("doc_id", F.lit("temperature")), F.lit(10)) < CALIBRATE).collect())
    shared.unpersist()
    rows = sorted(rows, key=lambda r: r["doc_id"])
    model = train(*(np.array([r[c] for r in rows], t) for c, t in (("x", float), ("good", float), ("weight", float), ("out", bool))))
    return model and {**model, "vectors": vectors}


class Scorer:
    def __init__(self, model: dict[str, Any]):
        self.model = model

    def scores(self, column: pa.Array) -> np.ndarray:
        m = self.model
        return sigmoid(logits(m["p"], standard(features(m["vectors"], column), m["mean"], m["scale"])) / m["temperature"])


def score(docs: DataFrame, model: dict[str, Any] | None, threshold: float = 0.5) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted (1 from
    ``threshold`` on); one pass, without a shuffle."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    if model is None:
        scored = src.select("doc_id", F.lit(0.0).alias("score"))
    else:
        shared = docs.sparkSession.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            scorer = on_worker("quality", shared, Scorer)
            for batch in batches:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scorer.scores(batch.column("text")))],
                                                 ["doc_id", "score"])

        scored = src.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
