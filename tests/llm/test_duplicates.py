"""Suffix, exact and near duplicates against brute force."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from repolens.llm import components, exact_dedup, mixing, simhash, suffix_dedup
from repolens.llm.registry import table

from .conftest import ROWS

SF = "/root/testdata/sf0.001"


# ------------------------------------------------------------------ suffix arrays
def brute_spans(docs, length):
    first = {}
    for o, t in docs:
        for i in range(len(t) - length + 1):
            w = t[i:i + length]
            first[w] = min(o, first.get(w, o))
    out = []
    for o, t in docs:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if first[t[i:i + length]] < o:
                gone[i:i + length] = b"\1" * length
        spans = []
        for i, x in enumerate(gone):
            if x and (not i or not gone[i - 1]):
                spans.append([i, i])
            if x:
                spans[-1][1] = i + 1
        out.append((o, [tuple(s) for s in spans], bytes(b for b, x in zip(t, gone) if not x)))
    return out


def check_suffix(df, length=50):
    rows = df.select("doc_id", "text").collect()
    want = sorted(brute_spans([(2**63 - 1 if r.doc_id is None else r.doc_id, (r.text or "").encode()) for r in rows], length))
    got = sorted((2**63 - 1 if r.doc_id is None else r.doc_id, [(s.start, s.end) for s in r.spans], bytes(r.kept))
                 for r in suffix_dedup.remove_repeats(df, length).collect())
    assert got == want
    return want


def test_repeats_of_the_table(spark):
    assert any(spans for _, spans, _ in check_suffix(table(spark, SF, "documents")))


def test_repeats_on_odd_rows(docs, no_docs):
    want = check_suffix(docs)
    assert [spans for o, spans, _ in want if o == 13] == [[(5, 75)]]
    assert suffix_dedup.remove_repeats(no_docs).count() == 0


def test_different_strings_around_a_hash_are_spread(spark):
    """A passage in many documents, each with surroundings of its own."""
    rng = np.random.default_rng(3)
    words = ["".join(chr(97 + c) for c in rng.integers(0, 26, 3 + k % 8)) for k in range(5000)]

    def some(n):
        return " ".join(words[k] for k in rng.integers(0, len(words), n))

    passage = some(60)
    rows = [(i, f"{some(20)} {passage} {some(20)}") for i in range(1500)]
    rows += [(2000 + i, rows[3 * i][1]) for i in range(40)]
    parts = 16
    tables = [pa.table({"ord": [o for o, _ in part], "text": [t for _, t in part], "g": [g] * len(part)})
              for g, part in enumerate(rows[k::8] for k in range(8))]
    told, sent = defaultdict(list), defaultdict(set)
    for t in tables:
        for r in suffix_dedup._tell(50, parts)(t).to_pylist():
            told[r["place"]].append((r["g"], r["blob"]))
    marked = [(p, *x) for p, packets in told.items() for x in suffix_dedup.mark(packets)]
    for g, t in enumerate(tables):
        mine = [m for m in marked if m[1] == g]
        for r in suffix_dedup._send(50, parts)(t, suffix_dedup._packets(mine)).to_pylist():
            if r["place"] != -1:
                least, _, _, _, size, flat = suffix_dedup._unpack(r["blob"])
                ends = np.cumsum(size)
                for h, a, b in zip(np.cumsum(least, dtype=np.int64).tolist(), (ends - size).tolist(), ends.tolist()):
                    sent[r["place"], h].add(flat[a:b].tobytes())
    assert max(map(len, sent.values())) <= 512       # 1000 and more at the edges of the passage if none is cut
    check_suffix(spark.createDataFrame(rows, "doc_id long, text string"))


def test_settled_packets_are_spread_by_group(spark):
    rows = [(-1, g, b"") for g in range(64)] + [(p, g, b"") for p in range(8) for g in range(8)]
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")                     # the table is small: one task would take all
    try:
        df = suffix_dedup._to_places(spark.createDataFrame(rows, suffix_dedup.PACKETS))
        seen = df.select("place", F.spark_partition_id().alias("task")).collect()
    finally:
        spark.conf.set(key, before)
    tasks = defaultdict(set)
    for r in seen:
        tasks[r.place].add(r.task)
    assert len(tasks[-1]) > 1
    assert all(len(tasks[p]) == 1 for p in range(8))


def test_shared_windows_and_previous_factors():
    rng = np.random.default_rng(0)
    for letters, length in ((2, 8), (2, 20), (2, 29), (1, 24), (26, 20)):
        text = rng.integers(97, 97 + letters, 300).astype(np.uint8)
        text[150:200] = text[20:70]
        at = np.flatnonzero(rng.random(300 - length) < 0.7)
        strings = [text[i:i + length].tobytes() for i in at]
        met, rank = suffix_dedup.shared_windows(np.concatenate([text, np.zeros(8, np.uint8)]), at, length)
        assert met.tolist() == [i for i, x in enumerate(strings) if strings.count(x) > 1]
        order = {x: r for r, x in enumerate(sorted({strings[i] for i in met}))}
        assert [order[strings[i]] for i in met] == np.unique(rank, return_inverse=True)[1].tolist()
    assert [len(x) for x in suffix_dedup.shared_windows(np.zeros(60, np.uint8), np.zeros(0, np.int64), 50)] == [0, 0]
    rank = np.array([0, 1, 0, 0, 1, 2])
    doc = np.array([5, 5, 5, 6, 7, 7])
    before, behind = suffix_dedup.previous_factors(rank, doc)
    assert before.tolist() == [-1, -1, -1, 2, 1, -1] and set(behind.tolist()) == {-1}


# ------------------------------------------------------------------ exact
def check_exact(df):
    rows = df.select("doc_id", "text").collect()
    groups = defaultdict(list)
    for r in rows:
        groups[exact_dedup.normalise(r.text)].append(r.doc_id)
    want = []
    for r in rows:
        ids = groups[exact_dedup.normalise(r.text)]
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        want.append((str(r.doc_id), str(keep), len(ids), r.doc_id == keep))
    got = exact_dedup.exact_dedup(df).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept) for r in got) == sorted(want)
    return groups


def test_exact_on_the_table_and_odd_rows(spark, docs, no_docs):
    check_exact(table(spark, SF, "documents"))
    groups = check_exact(docs)
    kept = exact_dedup.drop_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(exact_dedup.normalise(r.text) for r in kept.collect()) == sorted(groups)   # one row a text
    assert exact_dedup.drop_duplicates(no_docs).count() == 0


def test_clashing_identifiers_are_found_and_drawn_anew(spark):
    df = table(spark, SF, "documents")
    assert not exact_dedup.ambiguous_ids(exact_dedup.chunks(df, size=1)).isEmpty()
    got = exact_dedup.exact_dedup(df, id_bytes=1).select("doc_id", "keep_id").collect()
    assert sorted(got) == sorted(exact_dedup.exact_dedup(df).select("doc_id", "keep_id").collect())


def test_a_chunk_of_all_documents_moves_once_a_task(spark):
    shared = "".join(f"line {i} of a licence that all files carry\n" for i in range(2000))
    df = spark.range(4000, numPartitions=4).select(F.col("id").alias("doc_id"), F.concat(F.lit(shared), F.col("id")).alias("text"))
    sizes = [r["count"] for r in exact_dedup.chunks(df).groupBy("chunk_id").count().collect()]
    assert max(sizes) <= 4 and exact_dedup.ambiguous_ids(exact_dedup.chunks(df)).isEmpty()
    assert exact_dedup.exact_dedup(df).filter("kept").count() == 4000


def test_what_a_task_remembers_is_bounded():
    """A chunk that was forgotten is sent again; one with the same identifier
    and other bytes is always sent."""
    sent = exact_dedup.Sent(30)
    assert sent.new((b"a", b"x" * 10)) and sent.new((b"a", b"y" * 10)) and not sent.new((b"a", b"x" * 10))
    assert sent.new((b"b", b"z" * 20)) and sent.held == 30                 # forgets y, met longest ago
    assert not sent.new((b"a", b"x" * 10)) and sent.new((b"a", b"y" * 10))
    assert sent.new((b"c", b"w" * 50)) and list(sent.chunks) == [(b"c", b"w" * 50)] and sent.held == 50


def test_cuts_depend_on_nearby_bytes():
    rng = np.random.default_rng(1)
    a = bytes(rng.integers(97, 123, 40_000).astype(np.uint8))
    b = b"a new beginning" + a
    ends = {e + 15 for e in exact_dedup.cuts(a)}
    assert len(ends & set(exact_dedup.cuts(b))) > 0.8 * len(ends) and exact_dedup.cuts(a)[-1] == len(a)


# ------------------------------------------------------------------ near
def brute_near(rows, shingle, distance):
    fps = []
    for r in rows:
        words = (r.text or "").encode().lower().split()
        grams = [b" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
        h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        fps.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, r in enumerate(rows):
        if r.doc_id is not None:
            least[root(i)] = min(r.doc_id, least.get(root(i), r.doc_id))
    return [(str(r.doc_id), fps[i], str(least.get(root(i)))) for i, r in enumerate(rows)]


def check_near(df, distance):
    rows = df.select("doc_id", "text").collect()
    got = simhash.near_dedup(df, 3, distance).collect()
    assert sorted((str(r.doc_id), r.fp % 2**64, str(r.component_id)) for r in got) == sorted(brute_near(rows, 3, distance))
    return len({r.root for r in got})


def test_near_on_the_table_and_odd_rows(spark, docs, no_docs):
    check_near(table(spark, SF, "documents"), 3)
    n = check_near(docs, 3)
    kept = simhash.drop_near_duplicates(docs, 3, 3)
    assert kept.columns == docs.columns and kept.count() == n
    assert simhash.near_dedup(no_docs, 3, 3).count() == 0


def test_linked_equals_brute_force():
    rng = np.random.default_rng(2)
    for n, flips in ((900, 3), (400, 5), (1500, 1)):
        x = rng.integers(0, 2**63, 20, dtype=np.uint64)[rng.integers(0, 20, n)]
        for _ in range(flips):
            x = x ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64))
        x = np.unique(x)
        of = {int(v): int(v) for v in x} | dict(zip(*(a.tolist() for a in simhash.linked(x, 3))))
        sets = simhash._Joined(len(x))
        i, j = np.triu_indices(len(x), 1)
        near = np.bitwise_count(x[i] ^ x[j]) <= 3
        sets.join(i[near], j[near])
        name = {}
        assert all(name.setdefault(int(s), of[int(v)]) == of[int(v)] for s, v in zip(sets.of, x))
        assert len(set(name.values())) == len(name)


def test_every_close_pair_meets():
    rng = np.random.default_rng(4)
    masks = simhash.meeting_masks(3)
    for _ in range(2000):
        diff = sum(1 << int(b) for b in rng.choice(64, 3, replace=False))
        assert any(diff & m == 0 for m in masks)


def test_a_place_of_ten_thousand_equals_brute_force(spark):
    """All fingerprints agree in the bits of one first place; what is sent
    stays a few rows a fingerprint."""
    rng = np.random.default_rng(6)
    x = np.unique(rng.integers(0, 1 << 24, 9000).astype(np.uint64) << np.uint64(40) | np.uint64(0xABCDE))
    near = x[:1500] ^ (np.uint64(1) << rng.integers(40, 64, 1500).astype(np.uint64)) ^ (
        np.uint64(1) << rng.integers(0, 64, 1500).astype(np.uint64))
    x = np.unique(np.append(x, near))
    nodes = simhash.stored(spark.createDataFrame([(int(v),) for v in x.view(np.int64)], "fp long"))
    comps = {r.node: r.component for r in components.connected_components(simhash.links(nodes, 3)).collect()}
    sets = simhash._Joined(len(x))
    for a in range(0, len(x), 500):
        i, j = np.nonzero(np.bitwise_count(x[a:a + 500, None] ^ x[None]) <= 3)
        sets.join(i + a, j)
    signed = x.view(np.int64)
    name = {}
    for s, v in zip(sets.of.tolist(), signed.tolist()):
        assert name.setdefault(s, comps.get(v, v)) == comps.get(v, v)
    assert len(set(name.values())) == len(name) < len(x)
    # one round: every fingerprint of a crowded place goes to distance + 1 smaller ones
    met = nodes.select("fp", F.lit(1).cast("long").alias("place"))
    parts = simhash.split_places(met, simhash._sizes(met), 3)
    assert parts.count() == 4 * len(x)
    differ = simhash._sizes(parts).agg(F.max(F.bit_count("differ"))).first()[0]
    assert differ <= 64 - 64 // 4
    assert simhash._sizes(parts).agg(F.max("n")).first()[0] < len(x)


def test_column_names_do_not_clash(spark):
    """Names that the operators use inside come back with their values."""
    names = ["mix", "__keep_id", "__sha", "__row", "id", "row", "sha", "doc", "keep_id", "keep_sha", "a.b", "place"]
    rows = [(1, "One two three four", "src0"), (2, "one TWO three four", "src1"), (3, "else entirely here now", None), (3, None, "src0")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").select(
        "*", *[F.concat(F.lit(n + " of "), F.col("doc_id")).alias(n) for n in names])
    for out, ids in ((exact_dedup.drop_duplicates(docs), [2, 3, 3]), (simhash.drop_near_duplicates(docs, 3, 3), [1, 3, 3]),
                     (mixing.in_mixed_order(docs, {"src0": 1, "other": 1}, 2), [1, 2, 3, 3])):
        assert out.columns == docs.columns
        got = out.collect()
        assert sorted(r.doc_id for r in got) == ids
        assert all(r[n] == f"{n} of {r.doc_id}" for r in got for n in names)


def test_whole_rows_are_shuffled_once(spark, docs, capsys):
    """Of all that is shuffled, whole rows (one column) are so once; texts are
    not normalised by expressions, which make an object of each code point."""
    for out in (exact_dedup.drop_duplicates(docs), simhash.drop_near_duplicates(docs, 3, 3)):
        out.explain("formatted")
        plan = capsys.readouterr().out
        moved = re.findall(r"\n\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]", plan)
        assert len(moved) > 1 and sum("doc#" in m or "first(doc)" in m or "valueSet" in m for m in moved) == 1
        assert "translate(" not in plan


def test_one_row_of_a_doc_id_in_other_letters_stays(spark):
    rows = [(7, "Aa", "x"), (7, "aA", "y"), (7, "aA", "y"), (3, "aa", "z"), (None, "aa", "n"), (None, "", "e"), (None, None, "e")]
    kept = exact_dedup.drop_duplicates(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    least = min(["Aa", "aA"], key=lambda t: hashlib.sha256(t.encode()).hexdigest())
    assert sorted((str(r.doc_id), r.text or "", r.source) for r in kept) == [
        ("7", least, {"Aa": "x", "aA": "y"}[least]), ("None", "", "e")]


def test_small_places_keep_links(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 7)
    base = 0x0123456789ABCDEF
    fps = sorted({base ^ (1 << a) ^ (1 << b) for a in range(40, 52) for b in range(40, 52)})
    nodes = spark.createDataFrame([(f,) for f in fps], "fp long")
    comps = components.connected_components(simhash.links(nodes, 3)).collect()
    assert {r.node for r in comps} == set(fps) and {r.component for r in comps} == {fps[0]}


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(200, 100), (100, 100)], "src long, dst long")
    got = {r.node: r.component for r in components.connected_components(links).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 200: 100}
