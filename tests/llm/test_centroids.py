"""Centroid clustering against brute force."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repolens.llm import centroids, q_centroids
from repolens.llm.queries import QUERIES
from repolens.llm.registry import table

SF = "/root/testdata/sf0.001"
WIDE = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                     *(T.StructField(c, T.StringType()) for c in ("x", "cluster", "distance", "dots", "norm", "h", "n", "total"))])


def brute(rows, k, rounds, scale, seed="2:"):
    """Plain Python integers, every distance from scratch."""
    top = centroids.LARGEST
    x = [(v, [max(-top, min(top, math.floor(scale * c))) for c in e]) for v, e in rows]
    key = lambda r: (r[0] is None, "" if r[0] is None else hashlib.sha256(f"{seed}{r[0]}".encode()).hexdigest(), r[0] or 0, r[1])
    cs = [list(e) for _, e in sorted(x, key=key)[:k]]

    def assign():
        out = []
        for _, e in x:
            d = [sum((a - b) ** 2 for a, b in zip(e, c)) for c in cs]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        of = assign()
        for i in range(len(cs)):
            mine = [e for (_, e), (c, _) in zip(x, of) if c == i]
            if mine:
                cs[i] = [sum(col) // len(mine) for col in zip(*mine)]
    return sorted(((-1 if v is None else v), c, d) for (v, _), (c, d) in zip(x, assign())), cs


def got(done):
    return sorted(((-1 if r.vec_id is None else r.vec_id), r.cluster, r.distance) for r in done.assigned.collect())


def test_query_is_that_of_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF, "embeddings").collect()]
    want, cs = brute(rows, 40, 5, 256)
    out = QUERIES["op12_centroids"](spark, SF).collect()
    assert sorted((r.vec_id, r.cluster, r.distance) for r in out) == want
    assert {r.inertia for r in out} == {sum(d for *_, d in want)}
    for r in out:
        assert r.cluster_inertia == sum(d for _, c, d in want if c == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, cs[r.cluster])).encode()).hexdigest()


def test_products_are_exact_and_only_changes_are_added():
    rng = np.random.default_rng(0)
    for most in (1 << 7, 1 << 26):
        x, c = rng.integers(-most, most + 1, (50, 8)), rng.integers(-most, most + 1, (6, 8))
        exact = lambda c: [[sum(int(a) * int(b) for a, b in zip(r, q)) for q in c] for r in x]
        assert centroids.products(x, c).tolist() == exact(c)
        change = np.where(rng.random((6, 8)) < 0.2, rng.integers(-most, most + 1, (6, 8)), 0)
        change[2] = 0
        assert centroids.moved(centroids.products(x, c), x, change).tolist() == exact(c + change)


@pytest.mark.parametrize("k", [1, 3, 50])
def test_odd_rows(spark, k):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.25]), (2, [0.5, -0.25]), (2, [-1.0, 2.0]), (None, [0.1, 0.1]), (None, [0.1, 0.1]), (3, [1e300, -1e300]),
            (4, [0.0, -0.0039]), (5, [0.003, 9.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [-inf, 1.0]), (9, [None, 1.0]), (10, []),
            (11, None), (12, [1.0]), (13, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame([(*r, *["clash"] * 8) for r in rows], WIDE).repartition(3)
    done = centroids.cluster(df, k, 4, 2, 256, "2:")
    good = rows[:8]
    want, cs = brute(good, k, 4, 256)
    assert got(done) == want and done.centroids.tolist() == cs
    out = q_centroids.digest(done)
    assert out.count() == 8 and {r.inertia for r in out.collect()} == {min(2 ** 63 - 1, sum(d for *_, d in want))}


def test_empty_tables(spark):
    for rows in ([], [(1, None, *["c"] * 8)]):
        done = centroids.cluster(spark.createDataFrame(rows, WIDE), 40, 5, 64, 256, "2:")
        assert done.assigned.count() == 0 and q_centroids.digest(done).count() == 0


def test_a_vector_that_most_rows_repeat(spark):
    df = spark.range(300).select(F.col("id").alias("vec_id"), F.when(F.col("id") % 3 > 0, F.array(F.lit(0.5), F.lit(0.25)))
                                 .otherwise(F.array(F.rand(1) - 0.5, F.rand(2) - 0.5)).alias("embedding"))
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    want, _ = brute(rows, 7, 5, 256)
    assert got(centroids.cluster(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 7, 5, 2, 256, "2:")) == want
