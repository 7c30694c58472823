"""Language identification by hierarchical discrimination.

Support vector machines on character n-grams choose the language family
first; inside a family, one-versus-one machines separate its languages.
Both levels vote with the sum of a candidate's margins.  All machines are
linear, so their weights are columns of one matrix and a text is scored with
all of them in one product.

Features are the counts of hashed 1-, 2- and 3-grams of the text's letters
(lower-cased, anything else is one space), square-rooted and of length 1.
Training fits on at most ``TRAIN_PER_LANGUAGE`` whole texts of each of the
``LANGUAGES`` values of ``lang`` with most documents (texts of least hash of
doc_id; of rows that repeat a doc_id the least text).  Both bounds are the
same at every size: values beyond them, misspellings for instance, are not
learned.  Texts are counted where they are; the driver gets a row's n-gram
counts, at most 2^``BITS`` whatever the text's length.

Defined results: a null text or one without a letter is ``und`` with score
0; without any training row every text is ``und``; with one learned language
every text with a letter has it; language values outside ``FAMILIES`` are a
family each; rows with a null doc_id are never trained on and have
``held_out`` false; repeated rows are predicted row by row; an empty table
gives no rows; columns other than those named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe_vocab import on_worker, slices
from .toxicity import held_out

BITS = 13
TRAIN_PER_LANGUAGE = 400
LANGUAGES = 100           # there is a machine for each pair of values of a family
SPARE = 4                 # a sketch counts the rows: its error is a few hundredths
EPOCHS, BATCH, PENALTY = 30, 64, 1e-5
SLICE = 1 << 20           # code points of a text that are worked on at once

# Language families by ISO 639-1 code.
FAMILIES = {
    "germanic": ["en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "fy", "lb", "yi"],
    "romance": ["fr", "es", "it", "pt", "ro", "ca", "gl", "oc"],
    "slavic": ["ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "bs", "sl", "mk"],
    "baltic": ["lt", "lv"],
    "celtic": ["ga", "gd", "cy", "br"],
    "uralic": ["fi", "et", "hu"],
    "turkic": ["tr", "az", "kk", "uz", "tk", "ky"],
    "indo-aryan": ["hi", "bn", "ur", "mr", "gu", "pa", "ne", "si"],
    "dravidian": ["ta", "te", "kn", "ml"],
    "semitic": ["ar", "he", "mt", "am"],
    "malayo-polynesian": ["id", "ms", "tl", "jv", "su", "mg"],
}


def family_of(lang: str) -> str:
    code = lang.lower().split("-")[0].split("_")[0]
    return next((f for f, codes in FAMILIES.items() if code in codes), f"only {lang}")


_LETTERS: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.array([chr(i).isalpha() for i in range(0x110000)]))
    return _LETTERS[0]


def ngram_counts(text: str | None) -> np.ndarray | None:
    """Counts by hash bucket; None for a text without a letter."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), "<u4")
    counts, any_letter = np.zeros(1 << BITS), False
    for a in range(0, len(codes), SLICE):
        part = codes[a:a + SLICE]
        ok = _is_letter()[part]
        any_letter |= bool(ok.any())
        x = np.where(ok, part, 32).astype(np.uint32)
        space = x == 32
        x = x[~space | np.append(True, ~space[:-1])]
        x = np.concatenate([[32], x, [32]]).astype(np.uint32)
        for hashed in (x * np.uint32(0x9E3779B1),
                       x[:-1] * np.uint32(0x85EBCA77) + x[1:] * np.uint32(0xC2B2AE3D),
                       x[:-2] * np.uint32(0x27D4EB2F) + x[1:-1] * np.uint32(0x165667B1) + x[2:] * np.uint32(0x9E3779B1)):
            hashed = (hashed ^ (hashed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            counts += np.bincount(hashed >> np.uint32(32 - BITS), minlength=1 << BITS)
    return counts if any_letter else None


def scaled(counts: np.ndarray) -> np.ndarray:
    return np.sqrt(counts / counts.sum()).astype(np.float32)


def feature(text: str | None) -> np.ndarray | None:
    counts = ngram_counts(text)
    return None if counts is None else scaled(counts)


def machine(x: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, float]:
    """Linear support vector machine (hinge loss, averaged stochastic
    subgradients); y is 1 or -1, classes count alike."""
    n, d = x.shape
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * n
    w, b, steps = np.zeros(d, np.float32), 0.0, 0
    mean_w, mean_b = np.zeros(d, np.float32), 0.0
    for epoch in range(EPOCHS):
        order = rng.permutation(n)
        rate = 4.0 / (1 + epoch)
        for a in range(0, n, BATCH):
            i = order[a:a + BATCH]
            short = (x[i] @ w + b) * y[i] < 1
            pull = (weight[i] * y[i] * short / len(i)).astype(np.float32)
            w = w * np.float32(1 - rate * PENALTY) + np.float32(rate) * (pull @ x[i])
            b += rate * 0.1 * float(pull.sum())
            if epoch >= EPOCHS // 2:
                steps += 1
                mean_w += (w - mean_w) / steps
                mean_b += (b - mean_b) / steps
    return (mean_w, mean_b) if steps else (w, b)


def train(features: list[np.ndarray | None], langs: list[str], seed: int = 0) -> dict[str, Any] | None:
    rows = [(f, lang) for f, lang in zip(features, langs) if f is not None]
    if not rows:
        return None
    rng = np.random.default_rng(seed)
    x, lang = np.stack([f for f, _ in rows]), np.array([v for _, v in rows], dtype=object)
    family = np.array([family_of(v) for v in lang], dtype=object)
    columns, biases, plan = [], [], []

    def level(values: np.ndarray, among: np.ndarray) -> list[tuple[int, str, str]]:
        out = []
        for a, b in combinations(sorted(set(values[among])), 2):
            use = among & ((values == a) | (values == b))
            w, bias = machine(x[use], np.where(values[use] == a, 1, -1), rng)
            out.append((len(columns), a, b))
            columns.append(w)
            biases.append(bias)
        return out

    families = sorted(set(family))
    plan = {"families": (families, level(family, np.ones(len(x), bool)))}
    inside = {f: (sorted(set(lang[family == f])), level(lang, family == f)) for f in families}
    w = np.stack(columns, axis=1) if columns else np.zeros((1 << BITS, 0), np.float32)
    return {"w": w, "b": np.array(biases), "families": plan["families"], "inside": inside}


class Predictor:
    def __init__(self, model: dict[str, Any]):
        self.w, self.b, self.families, self.inside = (model[k] for k in ("w", "b", "families", "inside"))

    @staticmethod
    def _vote(level, margins: np.ndarray) -> tuple[str, float]:
        """The candidate of the greatest sum of margins, and a share from its
        closest duel."""
        names, duels = level
        sums, least = dict.fromkeys(names, 0.0), dict.fromkeys(names, np.inf)
        for k, a, b in duels:
            m = float(margins[k])
            for name, value in ((a, m), (b, -m)):
                sums[name] += value
                least[name] = min(least[name], value)
        best = max(names, key=lambda v: (sums[v], v))
        return best, 1.0 if not duels else float(1 / (1 + np.exp(-np.clip(2 * least[best], -30, 30))))

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out = []
        for t in texts:
            f = feature(t)
            if f is None:
                out.append(("und", 0.0))
                continue
            margins = f @ self.w + self.b
            family, sure = self._vote(self.families, margins)
            lang, surer = self._vote(self.inside[family], margins)
            out.append((lang, sure * surer))
        return out


def training_rows(docs: DataFrame) -> DataFrame:
    """doc_id, lang and text of the rows to learn from: at most LANGUAGES x
    TRAIN_PER_LANGUAGE, whatever repeats."""
    usable = docs.select("doc_id", "text", "lang").filter(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    ids = usable.select("doc_id", "lang", F.xxhash64("doc_id").alias("h"))
    sizes = (ids.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("size"))
             .orderBy(F.desc("size"), "lang").limit(LANGUAGES))
    # of a common language only the least hashes move: about SPARE times the rows that stay, however many tasks read it
    share = F.col("h").cast("double") / 2.0 ** 64 + 0.5
    least = (ids.join(F.broadcast(sizes), "lang")
             .filter(share * F.col("size") <= SPARE * TRAIN_PER_LANGUAGE).select("doc_id", "lang", "h").distinct())
    order = Window.partitionBy("lang").orderBy("h", "doc_id")
    chosen = (least.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= TRAIN_PER_LANGUAGE)
              .select("doc_id", "lang"))
    return (usable.join(F.broadcast(chosen), ["doc_id", "lang"])
            .groupBy("doc_id", "lang").agg(F.min("text").alias("text")))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The n-gram counts of texts with a letter: buckets that occur, how often."""
    for part in (part for batch in batches for part in slices(batch)):
        counts = [ngram_counts(t) for t in part.column("text").to_pylist()]
        found = [None if c is None else np.flatnonzero(c) for c in counts]
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), part.column("lang"), pa.array(found, pa.list_(pa.int32())),
             pa.array([None if c is None else c[f].astype(np.int64) for c, f in zip(counts, found)], pa.list_(pa.int64()))],
            ["doc_id", "lang", "buckets", "counts"])


def fit(docs: DataFrame) -> dict[str, Any] | None:
    rows = (training_rows(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text")
            .mapInArrow(_counted, "doc_id long, lang string, buckets array<int>, counts array<long>")
            .filter("buckets is not null").collect())
    features = []
    rows = sorted(rows, key=lambda r: (r["doc_id"], r["lang"]))
    for r in rows:
        dense = np.zeros(1 << BITS)
        dense[r["buckets"]] = r["counts"]
        features.append(scaled(dense))
    return train(features, [r["lang"] for r in rows])


def identify(docs: DataFrame, model: dict[str, Any] | None) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if model is None:
        found = src.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    else:
        shared = docs.sparkSession.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            predictor = on_worker("langid", shared, Predictor)
            for batch in batches:
                done = [x for part in slices(batch) for x in predictor.predict(part.column("text").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array([v for v, _ in done], pa.string()),
                     pa.array([s for _, s in done], pa.float64())], ["doc_id", "lang_pred", "score"])

        found = src.mapInArrow(run, "doc_id long, lang_pred string, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
