"""Chat formatting, mixing and fingerprints; oracle SQL of the package."""

import hashlib
import re
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from repolens.llm import chat, cws, mixing, queries
from repolens.llm.registry import table
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_equal_their_sql(spark, name):
    ok, detail = compare(spark, duck(SF), name, queries.QUERIES[name], queries.ORACLE[name], SF)
    assert ok, detail


def test_native_plans_have_no_python(spark):
    for name in ("op1_chat_format", "op9_mix_sources", "op10_cws_fingerprint"):
        plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop")), name


# ------------------------------------------------------------------ chat
def test_chat_round_trip_on_odd_rows(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "user", None), (1, 2, "assistant", "</s><\\/s>[SEP][/INST] \\[SEP]"),
            (2, None, None, "<s>[INST]"), (2, 0, "<s>x[INST]", "s>"), (None, 0, "assistant", ""), (3, 1, "assistant", "a"),
            (3, 1, "assistant", "a"), (3, 0, "assistant", "<"), (4, 0, "user", "y" * 200_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("segments", F.lit(1))
    out = chat.format_chat(df)
    got = {r.conv_id: r for r in out.withColumn("back", chat.read_back(F.col("formatted"))).collect()}
    assert len(got) == 5
    key = lambda t: (t[0] is not None, t[0] or 0, t[1], t[2])
    for conv, r in got.items():
        turns = sorted(((t, ro or "", x or "") for c, t, ro, x in rows if c == conv), key=key)
        assert [(m.role, x) for m in r.back for x in m.texts] == [(ro, x) for _, ro, x in turns]
        assert all(a.role != b.role for a, b in zip(r.back, r.back[1:]))
        assert "".join(s.text for s in r.segments) == r.formatted
    assert chat.digest(out.filter("conv_id = 3")).first().loss_sha256 == hashlib.sha256(b"<aa").hexdigest()
    assert chat.format_chat(df.limit(0)).count() == 0


# ------------------------------------------------------------------ mixing
def test_schedule_keeps_within_one_block(spark):
    weights = {"a": 7, "b": 1, "c": 4, "d": 3, "other": 5}
    rows = sorted(mixing.period(spark, weights).collect(), key=lambda r: r["at"])
    assert [r["at"] for r in rows] == list(range(20))
    for t in range(1, 21):
        for name, w in weights.items():
            had = sum(r["stream"] == name for r in rows[:t])
            assert abs(had - Fraction(t * w, 20)) < 1
    assert all(r["release"] <= r["at"] < r["deadline"] for r in rows)
    with pytest.raises(ValueError):
        mixing.check_weights({"a": 1})


def test_mix_on_odd_rows(docs, no_docs):
    weights = {"src0": 2, "src1": 1, "other": 1}
    out = mixing.mix(docs, weights, 2).collect()
    assert len(out) == docs.count()
    for stream in ("src0", "src1", "other"):
        ranks = sorted(r.mix["rank"] for r in out if r.mix.stream == stream)
        assert ranks == list(range(len(ranks)))
    slots = {}
    for r in out:
        assert r.mix.block == r.mix["rank"] // 2 and r.mix.release <= r.mix.slot < r.mix.deadline
        assert slots.setdefault(r.mix.slot, (r.mix.stream, r.mix.block)) == (r.mix.stream, r.mix.block)
    ordered = mixing.in_mixed_order(docs, weights, 2)
    assert ordered.columns == docs.columns
    place = {}
    for r in out:
        place.setdefault((r.doc_id, r.text), []).append((r.mix.slot, r.mix.place))
    at = [place[r.doc_id, r.text].pop() if len(place[r.doc_id, r.text]) == 1 else min(place[r.doc_id, r.text])
          for r in ordered.collect()]
    assert at == sorted(at)
    assert mixing.in_mixed_order(no_docs, weights, 2).count() == 0


# ------------------------------------------------------------------ fingerprints
def test_edited_texts_and_successors(spark):
    rows = sorted(table(spark, SF, "documents").select("doc_id", "text").collect())
    got = {r.doc_id: r for r in cws.fingerprints(table(spark, SF, "documents"), rows_per_range=16).collect()}
    for i, (doc, text) in enumerate(rows):
        following, half = rows[(i + 1) % len(rows)], len(text) // 2
        edited = text[:len(text) - half] + following.text[:half]
        r = got[doc]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        same = sum(a == b for a, b in zip(r.fingerprint, got[following.doc_id].fingerprint))
        assert r.near_next == same / cws.SAMPLES
    whole = {r.doc_id: r.fingerprint for r in cws.fingerprints(table(spark, SF, "documents")).collect()}
    assert whole == {d: r.fingerprint for d, r in got.items()}       # ranges don't show


def sampled(text):
    """The samples of a text in plain Python, from the same hashes."""
    from math import floor, log

    from xxhash import xxh64_intdigest

    def hashed(value, size, seed=42):
        return xxh64_intdigest((value % 2 ** (8 * size)).to_bytes(size, "little"), seed)

    best = [cws.NOTHING] * cws.SAMPLES
    counts = Counter(w for w in re.split("[ \t\n\x0b\f\r]+", text.lower()) if w)
    for word, n in counts.items():
        term = xxh64_intdigest(word.encode(), 42)
        for k in range(cws.SAMPLES):
            h = hashed(k, 4, hashed(term, 8))
            g = hashed(7, 4, hashed(h, 8))
            u1, u2, u3, u4, b = (((x >> s) % 2 ** bits + 0.5) / 2 ** bits for x, s, bits in (
                (h, 32, 32), (h, 0, 32), (g, 40, 24), (g, 16, 24), (g, 0, 16)))
            r, c = -log(u1 * u2), -log(u3 * u4)
            t = floor(log(n) / r + b)
            ln_a = log(c) - r * (t - b + 1)
            mark = hashed(t, 8, hashed(h, 8)) % 2**32
            best[k] = min(best[k], int((ln_a + 121) * 2**24) << 32 | mark)
    return best


def test_fingerprints_equal_samples_taken_one_by_one(spark):
    texts = ["a b c a", "A  b\tc\nd " * 9, "", None, "naïve École 日本 🤪 naïve", "one", "one one one two", "b c d e f g"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = cws.fingerprints(df, rows_per_range=3).orderBy("doc_id").collect()
    whole = [t or "" for t in texts]
    for i, r in enumerate(got):
        own, following = whole[i], whole[(i + 1) % len(whole)]
        edited = own[:len(own) - len(own) // 2] + following[:len(own) // 2]
        want, other, after = sampled(own), sampled(edited), sampled(following)
        assert r.fingerprint == want and r.edited_fingerprint == other
        assert r.near_edited == sum(x == y for x, y in zip(want, other)) / cws.SAMPLES
        assert r.near_next == sum(x == y for x, y in zip(want, after)) / cws.SAMPLES


def test_error_of_one_pair(spark):
    """A pair's likeness strays from its similarity by sqrt(s (1 - s) / SAMPLES)."""
    from math import sqrt
    n = 400
    df = spark.createDataFrame([(2 * i + k, " ".join(f"{w}{i}" for w in t.split())) for i in range(n)
                                for k, t in enumerate(("a b c d e f", "a b c d x y"))], "row long, text string")
    fp = {r.row: r.fingerprint for r in cws.sign(df, ["row"]).collect()}
    off = [sum(p == q for p, q in zip(fp[2 * i], fp[2 * i + 1])) / cws.SAMPLES - 0.5 for i in range(n)]
    assert abs(sum(off) / n) < 0.015 and abs(sqrt(sum(x * x for x in off) / n) - sqrt(0.25 / cws.SAMPLES)) < 0.012


def test_collisions_follow_the_generalised_jaccard_similarity(spark):
    texts = [("a b c d e f g h " * 3, "a b c d e f g h "), ("a b c d e f g h i j", "a b c d e k l m n o"),
             ("a a a a b b c", "a b b b c c c d")]
    errors = []
    for n in range(60):        # other words, other samples
        for x, y in texts:
            x, y = (" ".join(f"{w}{n}" for w in t.split()) for t in (x, y))
            errors.append((x, y))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(t for pair in errors for t in pair)], "row long, text string")
    fp = {r.row: r.fingerprint for r in cws.sign(df, ["row"]).collect()}
    for k in range(3):
        seen = want = 0.0
        for i, (x, y) in enumerate(errors):
            if i % 3 == k:
                a, b = Counter(x.split()), Counter(y.split())
                want += sum((a & b).values()) / sum((a | b).values()) / 60
                seen += sum(p == q for p, q in zip(fp[2 * i], fp[2 * i + 1])) / cws.SAMPLES / 60
        assert abs(seen - want) < 0.04


def test_fingerprints_on_odd_rows(docs, no_docs):
    out = cws.fingerprints(docs, rows_per_range=3).collect()
    assert len(out) == docs.count()
    none = [r for r in out if set(r.fingerprint) == {cws.NOTHING}]
    assert sorted(r.doc_id for r in none) == [3, 4, 5]
    assert cws.fingerprints(no_docs).count() == 0
