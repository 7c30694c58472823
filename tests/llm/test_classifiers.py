"""Held-out accuracy of the classifiers, the network's gradients, odd rows."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from repolens.llm import langid, toxicity
from repolens.llm.registry import table

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def network(spark):
    return toxicity.fit(table(spark, SF, "documents"), table(spark, SF, "labels"))


def test_toxicity_on_held_out_rows(spark, network):
    rows = (toxicity.score(table(spark, SF, "documents"), network).filter("held_out")
            .join(table(spark, SF, "labels"), "doc_id").collect())
    hits = sum(r.predicted == r.toxic for r in rows) / len(rows)
    assert len(rows) > 50 and hits > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_gradients_are_those_of_finite_differences():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in toxicity.start(5, rng).items()}
    gates = rng.standard_normal((7, 6 * toxicity.HIDDEN))
    at = rng.integers(0, 7, (3, 4))
    mask = np.array([[1, 1, 1, 1], [1, 1, 0, 0], [1, 1, 1, 0]], np.float64)
    pull = rng.standard_normal(3)
    loss = lambda: float((toxicity.forward(p, gates, at, mask) * pull).sum())
    _, kept = toxicity.forward(p, gates, at, mask, keep=True)
    g, d_gates = toxicity.backward(p, at, mask, kept, pull, 7)
    for array, grad in [(p["u"], g["u"]), (p["wa"], g["wa"]), (p["va"], g["va"]), (p["wo"], g["wo"]), (gates, d_gates)]:
        for _ in range(6):
            i = tuple(int(rng.integers(0, n)) for n in array.shape)
            old, h = array[i], 1e-3
            array[i] = old + h
            up = loss()
            array[i] = old - h
            down = loss()
            array[i] = old
            assert abs((up - down) / (2 * h) - grad[i]) < 5e-3


def test_scores_are_those_of_windows_taken_one_by_one():
    """Against the network written out word by word, without masks or shared
    rows: the score of a text is that of its highest window."""
    rng = np.random.default_rng(3)
    vocabulary = {"you": 1, "stupid": 2, "kind": 3}
    p = {k: v.astype(np.float64) for k, v in toxicity.start(len(vocabulary), rng).items()}
    p["b"], p["bo"], h = rng.standard_normal(p["b"].shape) * 0.3, np.array([0.2]), toxicity.HIDDEN
    sigma = lambda v: 1 / (1 + np.exp(-v))

    def embedded(w):
        marked, own = f"\x02{w}\x03", []
        for i in range(len(marked) - 2):
            x = sum(ord(c) * m for c, m in zip(marked[i:i + 3], (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D))) % 2**32
            own.append(p["char"][(x ^ x >> 15) * 0x2C1B3C6D % 2**32 >> 32 - toxicity.GRAM_BITS])
        return np.concatenate([p["word"][vocabulary.get(w, 0)], np.mean(own, axis=0)])

    def run(inputs, k):
        s, out = np.zeros(h), []
        for x in inputs:
            g, r = x @ p["wx"][k] + p["b"][k], s @ p["u"][k]
            z, reset = sigma(g[:h] + r[:h]), sigma(g[h:2 * h] + r[h:2 * h])
            s = (1 - z) * s + z * np.tanh(g[2 * h:] + reset * r[2 * h:])
            out.append(s)
        return out

    def logit(words):
        inputs = [embedded(w) for w in words]
        states = [np.concatenate(x) for x in zip(run(inputs, 0), run(inputs[::-1], 1)[::-1])]
        share = np.exp([np.tanh(s @ p["wa"]) @ p["va"] for s in states])
        return sum(a * s for a, s in zip(share / share.sum(), states)) @ p["wo"] + p["bo"][0]

    some = ["you", "stupid", "kind", "né", "a", "person", "日本", "x1"]
    texts = [" ".join(some[i] for i in rng.integers(0, len(some), n)) for n in (1, 2, 5, 31, 32, 33, 48, 49, 100)]
    got = toxicity.Scorer({"p": p, "vocabulary": vocabulary}).scores(texts)
    for text, score in zip(texts, got):
        words = text.split()
        starts = {*range(0, max(1, len(words) - toxicity.WINDOW + 1), toxicity.STRIDE), max(0, len(words) - toxicity.WINDOW)}
        assert abs(score - sigma(max(logit(words[a:a + toxicity.WINDOW]) for a in starts))) < 1e-5


def test_windows_cover_every_word():
    for n in (0, 1, 31, 32, 33, 56, 57, 500):
        seen = {w for a in toxicity.windows(n) for w in range(a, min(n, a + toxicity.WINDOW))}
        assert seen == set(range(n))


def test_toxicity_on_odd_rows(spark, docs, no_docs, network):
    out = toxicity.score(docs, network).collect()
    assert len(out) == docs.count() and not any(r.held_out for r in out if r.doc_id is None)
    kept = toxicity.drop_toxic(docs, network)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted == 0 for r in out)
    assert toxicity.score(no_docs, network).count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.fit(docs, labels) is None
    assert {r.score for r in toxicity.score(docs, None).collect()} == {0.0}


def test_labels_without_documents_do_not_use_up_the_sample(spark):
    docs = spark.range(4000, 4200).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"))
    labels = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    for toxic in (0, 1):
        rows = toxicity.training_rows(docs, labels, toxic, 20).collect()
        assert len(rows) == 20 and all(4000 <= r.doc_id < 4200 and r.toxic == toxic for r in rows)


def test_phrases_of_half_a_window_lie_whole_in_one():
    phrase = toxicity.WINDOW // 2 + 1
    for n in (17, 32, 33, 48, 49, 57, 500):
        first = toxicity.windows(n)
        assert all(any(a <= k and k + phrase <= a + toxicity.WINDOW for a in first) for k in range(n - phrase + 1))


def test_language_on_held_out_rows(spark):
    df = table(spark, SF, "documents")
    rows = langid.identify(df, langid.fit(df)).filter("held_out").join(df.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang_pred == r.lang for r in rows) / len(rows) > 0.95


def test_languages_are_voted_for_as_by_hand():
    """Margins, votes and scores of a text against plain loops over the model."""
    words = {"en": "the house is", "de": "das haus ist", "fr": "la maison est", "es": "la casa es", "xx": "qq zz qzq"}
    texts = [(f"{t} {i}", v) for v, t in words.items() for i in "abcdefgh"]
    model = langid.train([langid.feature(t) for t, _ in texts], [v for _, v in texts])
    level = {"": (["germanic", "only xx", "romance"], model["families"][1])}
    level |= {f: (sorted(v for v in words if langid.family_of(v) == f), model["inside"][f][1]) for f in level[""][0]}
    assert model["families"][0] == level[""][0] and {f: m[0] for f, m in model["inside"].items()} == {
        f: names for f, (names, _) in level.items() if f}

    def duel(counts, k):
        total = sum(counts.values())
        return sum((n / total) ** 0.5 * float(model["w"][i, k]) for i, n in counts.items()) + float(model["b"][k])

    def winner(counts, names, duels):
        assert sorted((a, b) for _, a, b in duels) == [(a, b) for i, a in enumerate(names) for b in names[i + 1:]]
        against = {n: [] for n in names}
        for k, a, b in duels:
            m = duel(counts, k)
            against[a].append(m)
            against[b].append(-m)
        best = max(names, key=lambda n: sum(against[n]))
        return best, 1 / (1 + np.exp(-2 * min(against[best]))) if duels else 1.0

    asked = ["the casa", "Das Haus!", "maison 7 est", "qzq", "is is is la", "zzz the"]
    for text, (lang, score) in zip(asked, langid.Predictor(model).predict(asked)):
        counts = Counter()
        clean = re.sub(" +", " ", "".join(c if c.isalpha() else " " for c in text.lower()))
        for n, mults in ((1, [0x9E3779B1]), (2, [0x85EBCA77, 0xC2B2AE3D]), (3, [0x27D4EB2F, 0x165667B1, 0x9E3779B1])):
            padded = " " + clean + " "
            for i in range(len(padded) - n + 1):
                h = sum(ord(c) * m for c, m in zip(padded[i:i + n], mults)) % 2**32
                counts[(h ^ h >> 15) * 0x2C1B3C6D % 2**32 >> 32 - langid.BITS] += 1
        family, sure = winner(counts, *level[""])
        want, surer = winner(counts, *level[family])
        assert lang == want and abs(score - sure * surer) < 1e-4
    assert {v for v, _ in langid.Predictor(model).predict([t for t, _ in texts])} == set(words)


def test_learned_languages_and_gathered_bytes_are_bounded(spark, monkeypatch):
    """Of many values those with most documents are learned; the same model
    comes from the workers' counts as from whole texts."""
    monkeypatch.setattr(langid, "LANGUAGES", 3)
    docs = spark.createDataFrame(
        [(i, f"{'la casa' if i % 2 else 'the house'} {'word ' * (i % 5)}", ("en", "es")[i % 2]) for i in range(60)]
        + [(100 + i, "la maison", "fr") for i in range(30)] + [(200 + i, "junk", f"dirty{i}") for i in range(200)]
        + [(1000, "123", "en")], "doc_id long, text string, lang string")
    rows = langid.training_rows(docs).collect()
    assert {r.lang for r in rows} == {"en", "es", "fr"}
    rows.sort(key=lambda r: (r.doc_id, r.lang))
    want = langid.train([langid.feature(r.text) for r in rows], [r.lang for r in rows])
    got = langid.fit(docs)
    assert np.array_equal(got["w"], want["w"]) and np.array_equal(got["b"], want["b"])
    assert got["families"] == want["families"] and got["inside"] == want["inside"]


def test_language_on_odd_rows(docs, no_docs):
    model = langid.fit(docs)
    out = langid.identify(docs, model).collect()
    assert len(out) == docs.count()
    by = {r.doc_id: r.lang_pred for r in out}
    assert by[3] == by[4] == by[5] == by[11] == "und" and by[1] in ("en", "fr", "de")
    assert langid.fit(no_docs) is None and langid.identify(no_docs, None).count() == 0
    assert {r.lang_pred for r in langid.identify(docs, None).collect()} == {"und"}
    one = langid.train([langid.feature(t) for t in ("the words", "and more")], ["en", "en"])
    assert langid.Predictor(one).predict(["anything", "1 2"]) == [("en", 1.0), ("und", 0.0)]


def test_rows_to_learn_from_stay_bounded(spark):
    """A language that holds nearly all rows, ids that repeat: no more than the
    stated rows are learnt from, those of least hash."""
    docs = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"),
        F.when(F.col("id") % 100 == 0, "fr").otherwise("en").alias("lang"))
    again = docs.filter("doc_id < 50").withColumn("text", F.lit("zzz"))
    for _ in range(5):
        docs = docs.unionByName(again)
    seen = langid.training_rows(docs).collect()
    usable = docs.filter(~langid.held_out(F.col("doc_id"))).select("doc_id", "lang", F.xxhash64("doc_id").alias("h")).distinct()
    for lang in ("en", "fr"):
        want = [f"text {r.doc_id}" for r in usable.filter(F.col("lang") == lang).orderBy("h").limit(langid.TRAIN_PER_LANGUAGE).collect()]
        assert sorted(want) == sorted(r.text for r in seen if r.lang == lang)

    labels = spark.range(50).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    rows = toxicity.training_rows(docs, labels, 1, 10).collect()
    assert len(rows) == 10 == len({r.doc_id for r in rows}) and all(r.text == f"text {r.doc_id}" for r in rows)


def test_inputs_of_words_stay_in_one_table(monkeypatch):
    model = toxicity.train(["you are a stupid fool", "a nice day it is", "stupid stupid you", "the day is long"] * 6, [1, 0, 1, 0] * 6)
    texts = [" ".join(f"w{i}x{j % 7}" for j in range(i, i + 9)) + " stupid" * (i % 3 == 0) for i in range(12)]
    want = [toxicity.Scorer(model).scores([t])[0] for t in texts]
    scorer = toxicity.Scorer(model)
    table = scorer.gates
    assert np.allclose(scorer.scores(texts), want, atol=1e-6) and scorer.gates is table     # no copy for new words
    monkeypatch.setattr(toxicity, "KNOWN_WORDS", 20)
    scorer = toxicity.Scorer(model)
    for _ in range(2):      # more words than the table holds, in one group and in many
        assert np.allclose(scorer.scores(texts), want, atol=1e-6) and len(scorer.rows) <= len(scorer.gates)
        assert np.allclose([scorer.scores([t])[0] for t in texts], want, atol=1e-6) and len(scorer.gates) < 40
