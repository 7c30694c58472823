"""Quality: word vectors and features by plain loops, the network's gradients,
held-out accuracy, odd rows."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from repolens.llm import quality
from repolens.llm.queries import QUERIES
from repolens.llm.registry import table

SF = "/root/testdata/sf0.1"
TEXTS = ["The cat sat, the dog\tate 12 fish!!", "", "  \n ", "ÉCOLE naïve -- x1y2 日本語 ***", "a", "the THE the", "b c" * 40]


def column(texts):
    return pa.array(texts, pa.string())


def words_of(texts):
    return [w for d, o in quality._chunks(column(texts)) for w in zip(*(x.tolist() for x in quality.tokens(d, o)))]


def brute_tokens(text):
    kind = lambda b: 0 if b <= 32 or b == 127 else 3 if 48 <= b < 58 else 1 if b >= 128 or chr(b).isalpha() else 2
    out, last = [], 0
    for b in text.encode():
        if kind(b) and kind(b) == last:
            out[-1] += bytes([b])
        elif kind(b):
            out.append(bytes([b]))
        last = kind(b)
    return out


def test_tokens_are_runs_of_a_kind():
    found = {}
    for text in TEXTS:
        got, want = words_of([text]), brute_tokens(text)
        assert len(got) == len(want)
        for (w, _), t in zip(got, want):
            assert found.setdefault(t, w) == w
    assert len(set(found.values())) > 0.9 * len(found)
    assert [t for _, t in words_of(TEXTS)] == [i for i, t in enumerate(TEXTS) for _ in brute_tokens(t)]


def test_pieces_and_slices_do_not_change_words(monkeypatch):
    want = words_of(TEXTS)
    monkeypatch.setattr(quality, "PIECE", 5)
    assert words_of(TEXTS) == want
    part = column(["x y", *TEXTS, "z"]).slice(1, len(TEXTS))
    assert [w for d, o in quality._chunks(part) for w in quality.tokens(d, o)[0].tolist()] == [w for w, _ in want]
    monkeypatch.setattr(quality, "CHUNK_BYTES", 8)
    assert [w for w, _ in words_of(TEXTS)] == [w for w, _ in want]


def test_pooling_in_pieces_is_the_same(monkeypatch):
    vectors = np.random.default_rng(2).standard_normal((quality.WORDS, quality.DIMENSION)).astype(np.float32)
    want = quality.features(vectors, column(TEXTS))
    monkeypatch.setattr(quality, "PIECE", 3 << 6)
    assert np.allclose(quality.features(vectors, column(TEXTS)), want, atol=1e-3, equal_nan=True)


def brute_sums(texts):
    index, out = quality.index_vectors(), np.zeros((quality.WORDS, quality.DIMENSION), np.int64)
    vector = np.zeros_like(out)
    for w in range(quality.WORDS):
        for e in index[w].tolist():
            vector[w, e // 2] = 1 - 2 * (e % 2)
    for text in texts:
        ws = [w for w, _ in words_of([text or ""])]
        for i, w in enumerate(ws):
            for j in range(max(0, i - quality.NEAR), min(len(ws), i + quality.NEAR + 1)):
                if j != i:
                    out[w] += vector[ws[j]]
    return out


def test_word_vectors_and_features_are_those_of_plain_loops(spark):
    texts = [*TEXTS, None, *TEXTS[:3]]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    sums = quality.context_sums(docs)
    assert (sums == brute_sums(texts)).all()
    vectors = quality.word_vectors(sums)
    known = sums.any(axis=1)
    assert not vectors[~known].any() and abs(vectors[known].mean(axis=0)).max() < 1e-6
    got = quality.features(vectors, column(TEXTS))
    for row, text in zip(got, TEXTS):
        v = vectors[[w for w, _ in words_of([text])]].astype(np.float64)
        want = np.concatenate([v.mean(0), v.std(0)]) if len(v) else np.zeros(2 * quality.DIMENSION)
        way = np.sqrt((np.diff(v, axis=0) ** 2).sum(1).mean() / (2 * v.var(0).sum())) if len(v) > 1 else np.nan
        assert np.allclose(row, [*want, way], atol=1e-3, equal_nan=True)


def test_gradients_are_those_of_finite_differences():
    rng = np.random.default_rng(0)
    p = {"w1": rng.standard_normal((6, 4)), "b1": rng.standard_normal(4), "w2": rng.standard_normal(4), "b2": rng.standard_normal(1)}
    x, y, weight = rng.standard_normal((9, 6)), rng.integers(0, 2, 9).astype(float), rng.random(9) + 0.1
    g = quality.gradients(p, x, y, weight)
    for k, v in p.items():
        for i in np.ndindex(v.shape):
            old, h = v[i], 1e-5
            v[i] = old + h
            up = quality.log_loss(quality.logits(p, x), y, weight)
            v[i] = old - h
            down = quality.log_loss(quality.logits(p, x), y, weight)
            v[i] = old
            assert abs((up - down) / (2 * h) - g[k][i]) < 1e-7


def test_temperature_is_that_of_least_loss():
    rng = np.random.default_rng(1)
    logit = rng.standard_normal(4000) * 2
    y = (rng.random(4000) < quality.sigmoid(logit)).astype(float)
    weight = np.ones(4000)
    for factor in (0.25, 1, 6):         # logits that are too small or too large are set right
        t = quality.temperature(logit * factor, y, weight)
        assert abs(t / factor - 1) < 0.15
        best = min(quality.log_loss(logit * factor / s, y, weight) for s in np.exp(np.linspace(-3, 3, 200)))
        assert quality.log_loss(logit * factor / t, y, weight) <= best + 1e-9


@pytest.fixture(scope="module")
def model(spark):
    return quality.fit(table(spark, SF, "documents"), table(spark, SF, "labels"))


def test_quality_on_held_out_rows(spark, model):
    rows = (quality.score(table(spark, SF, "documents"), model, 0.3).filter("held_out")
            .join(table(spark, SF, "labels"), "doc_id").collect())
    poor, good = ([r for r in rows if r.quality == q] for q in (0, 1))
    assert len(poor) > 50 and sum(r.predicted for r in poor) < 0.09 * len(poor)
    assert sum(r.predicted for r in good) > 0.99 * len(good)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    # probabilities: their mean is the share of good rows
    assert abs(np.mean([r.score for r in rows]) - len(good) / len(rows)) < 0.03


def test_quality_on_odd_rows(spark, docs, no_docs, model):
    out = quality.score(docs, model).collect()
    assert len(out) == docs.count() and not any(r.held_out for r in out if r.doc_id is None)
    assert len({r.score for r in out if r.doc_id in (3, 4)}) == 1
    assert quality.score(no_docs, model).count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.fit(docs, labels) is None and quality.fit(no_docs, labels) is None
    assert {r.score for r in quality.score(docs, None).collect()} == {0.0}
    few = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (10, 0), (77, 1)], "doc_id long, quality int")
    rows = quality.training_rows(docs, few).collect()
    assert sorted((r.doc_id, r.good) for r in rows) == [(i, g) for i, g in ((1, 1), (10, 0)) if not held(spark, i)]
    assert all(0 <= r.score <= 1 for r in quality.score(docs, quality.fit(docs, few)).collect())


def held(spark, i):
    return spark.range(1).select(quality.held_out(F.lit(i))).first()[0]


def test_rows_to_learn_from_are_bounded_and_weighted(spark, monkeypatch):
    monkeypatch.setattr(quality, "TRAIN_EACH", 40)
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"))
    docs = docs.unionByName(docs.filter("doc_id < 900"))
    labels = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") % 10 > 0).cast("int").alias("quality"))
    rows = quality.training_rows(docs, labels).collect()
    learnt = docs.select("doc_id").distinct().filter(~quality.held_out(F.col("doc_id")))
    for good in (0, 1):
        mine = [r for r in rows if r.good == good]
        n = learnt.filter((F.col("doc_id") % 10 > 0).cast("int") == good).count()
        assert len(mine) == 40 and abs(sum(r.weight for r in mine) - n) < 1e-6
        least = learnt.filter((F.col("doc_id") % 10 > 0).cast("int") == good).orderBy(F.xxhash64("doc_id")).limit(40)
        assert {r.doc_id for r in mine} == {r.doc_id for r in least.collect()}


def test_query_scores_every_row(spark):
    sf = "/root/testdata/sf0.001"
    assert QUERIES["op11_quality"](spark, sf).count() == table(spark, sf, "documents").count()
