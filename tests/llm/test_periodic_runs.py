"""Runs of words against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from repolens.llm import periodic_runs, q_periodic_runs
from repolens.llm.queries import QUERIES
from repolens.llm.registry import table

from .conftest import DOCS

SF = "/root/testdata/sf0.001"


def brute(t, least=12):
    """Every period, every position."""
    seen, out = set(), []
    for q in range(1, len(t) // 2 + 1):
        i = 0
        while i + q < len(t):
            j = i
            while j + q < len(t) and t[j] == t[j + q]:
                j += 1
            if j - i >= q and (i, j + q) not in seen:
                seen.add((i, j + q))
                if j + q - i >= least:
                    out.append((i, j + q - i, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def words_of(rng):
    kind, letters = rng.randrange(6), rng.choice([1, 2, 2, 3])
    if kind == 0:
        return [rng.randrange(letters) for _ in range(rng.randrange(200))]
    if kind == 1:
        return ([rng.randrange(letters) for _ in range(rng.randrange(1, 40))] * 5)[:rng.randrange(1, 200)]
    if kind == 2:                               # repeats inside repeats
        t = [0]
        while len(t) < 200:
            a = rng.randrange(len(t))
            t = t + t[a:rng.randrange(a, len(t)) + 1] * rng.randrange(1, 4) + [rng.randrange(3)] * rng.randrange(2)
        return t[:400]
    if kind == 3:
        a, b = [0], [0, 1]
        while len(b) < 300:
            a, b = b, b + a
        return b[:rng.randrange(300)]
    if kind == 4:
        return [i.bit_count() % 2 for i in range(rng.randrange(400))]
    u = ([rng.randrange(2) for _ in range(rng.randrange(1, 5))] * 90)[:rng.randrange(9, 90)]
    return u * rng.randrange(2, 5) + [rng.randrange(3) for _ in range(rng.randrange(20))]     # a highly periodic period


def found(texts, least=12):
    return [list(zip(*(x.tolist() for x in r))) for r in
            periodic_runs.runs([np.array(t, np.int64) for t in texts], least)]


def test_runs_are_those_of_brute_force():
    rng = random.Random(7)
    for _ in range(250):
        texts = [words_of(rng) for _ in range(rng.randrange(6))]
        assert found(texts) == [brute(t) for t in texts]
    assert found([[1, 2] * 40 + [3] * 30], 20) == [brute([1, 2] * 40 + [3] * 30, 20)]
    with pytest.raises(ValueError):
        periodic_runs.runs([], 5)


def test_clashing_hashes_are_checked_word_by_word(monkeypatch):
    """Hashes of 6 bits: nearly all proposals and extensions are wrong."""
    plain = periodic_runs.Line.hashes
    monkeypatch.setattr(periodic_runs.Line, "hashes", lambda self, at, size: plain(self, at, size) & np.uint64(63))
    rng = random.Random(3)
    for _ in range(60):
        texts = [words_of(rng) for _ in range(3)]
        assert found(texts) == [brute(t) for t in texts]


def test_positions_depend_on_their_words_alone():
    """The same 2t words are selected wherever they stand, and no 3t - 1 words
    without a short period go without a position."""
    rng = random.Random(5)
    t = 4
    for _ in range(50):
        text = [rng.randrange(2) for _ in range(150)]
        line = periodic_runs.Line([np.array(text)])
        short = lambda i, n: any(all(text[k] == text[k + p] for k in range(i, i + n - p)) for p in range(1, t // 3 + 1))
        periodic = np.array([i + t <= 150 and short(i, t) for i in range(151)])
        chosen = set(periodic_runs.synchronising(line, t, 151, periodic).tolist())
        context = {}
        for i in range(150 - 2 * t + 1):
            assert context.setdefault(tuple(text[i:i + 2 * t]), i in chosen) == (i in chosen)
        for i in range(150 - 3 * t + 2):
            assert short(i, 3 * t - 1) == (not chosen & set(range(i, i + t)))


def expected(rows):
    out = []
    for doc_id, text in rows:
        words = (text or "").encode().split()
        n, h = len(words), None if doc_id is None else zlib.crc32(str(doc_id).encode())
        if n and h is not None and h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = brute(words)
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        out.append((doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
                    sha("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()),
                    sha(b" ".join(w for i, w in enumerate(words) if i not in gone))))
    return sorted(out, key=str)


def test_query_is_that_of_brute_force(spark):
    # brute force is quadratic: the shorter documents, whole
    docs = table(spark, SF, "documents").filter(F.length("text") < 6000)
    out = q_periodic_runs.digest(periodic_runs.find_runs(q_periodic_runs.with_periods(docs)))
    got = sorted((tuple(r) for r in out.collect()), key=str)
    assert got == expected([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert sum(r[1] > 0 for r in got) > len(got) // 20
    assert QUERIES["op13_periodic_runs"](spark, SF).count() == table(spark, SF, "documents").count()


def test_odd_rows(spark, docs, no_docs):
    more = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in [
        (90, "a b " * 9 + "x"), (90, "    a\x0bb\x0ca\tb\r\n" * 6), (91, "one"), (None, "z " * 40)]], DOCS)
    rows = docs.select(*DOCS.names).unionByName(more)
    wide = rows.withColumns({c: F.lit("clash") for c in ("w", "n", "runs", "best", "words", "start", "n_words", "collapsed")})
    out = q_periodic_runs.digest(periodic_runs.find_runs(q_periodic_runs.with_periods(wide)))
    # the two long texts of the odd rows are one run: brute force on shorter ones, these by hand
    short = [(r.doc_id, r.text) for r in rows.collect() if r.doc_id not in (7, 8)]
    got = sorted((tuple(r) for r in out.collect()), key=str)
    assert [r for r in got if r[0] not in (7, 8)] == expected(short)
    assert [r[1:5] for r in got if r[0] in (7, 8)] == [(1, 0, 28000, 7), (1, 0, 28000, 7)]
    empty = periodic_runs.find_runs(no_docs)
    assert empty.count() == 0 and q_periodic_runs.digest(empty).columns == out.columns
