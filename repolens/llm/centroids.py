"""Centroid clustering of integer vectors by an incremental matrix of dot
products.

Components x become floor(``scale`` * x).  With every vector the exact
integer products with all centroids are persisted, so its squared distances
are norm - 2 * product + norm of the centroid.  When centroids move, a product
changes only by the components of its centroid that changed: each round adds
those (exact integers: by floating-point matrix products only where every
sum stays under 2^53), takes the least distance anew and writes the state as
Parquet to the shared folder of ``spark.checkpoint.dir``; the state before it
is then deleted.  A round in which no component changes is not written again.
Vectors never move between tasks: a round shuffles one row per task, cluster
and component, and the driver sees ``k`` centroids only.

Defined results: vectors with another number of components, or with one that
is null or not finite, or null vectors, are left out; integers beyond
+-``LARGEST`` are taken as that (squared distances would not fit a long); null
vec_ids are clustered but start no centroid unless others are too few; rows
that repeat a vec_id are vectors of their own (ties of the start: by vec_id,
then components); fewer vectors than ``k`` give as many centroids; an empty
centroid stays where it is; an empty table gives no rows; columns other than
vec_id and embedding are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sinks import delete
from ..session import checkpoint_root

LARGEST = 1 << 26
STATE = "vec_id long, x array<int>, norm long, dots array<long>, cluster int, distance long"


# ------------------------------------------------------------------ arrays
def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array(values.ravel(), kind))


def products(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact products of the rows of ``x`` and ``c``."""
    if not x.size or not c.size:
        return np.zeros((len(x), len(c)), np.int64)
    if int(np.abs(x).max()) * int(np.abs(c).max()) * x.shape[1] < 1 << 53:
        return (x.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64)
    return x @ c.T


def moved(dots: np.ndarray, x: np.ndarray, change: np.ndarray) -> np.ndarray:
    """``dots`` after the centroids changed by ``change``: centroids that did
    not move keep their products, the others gain those of their changed
    components."""
    out = dots.copy()
    for k in np.flatnonzero(change.any(axis=1)).tolist():
        j = np.flatnonzero(change[k])
        out[:, k] += products(x[:, j], change[k:k + 1, j])[:, 0]
    return out


def nearest(norm: np.ndarray, dots: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (ties: the smaller) and its squared
    distance."""
    d = norm[:, None] - 2 * dots + (centroids * centroids).sum(axis=1)
    best = d.argmin(axis=1)
    return best, d[np.arange(len(d)), best]


def means(old: np.ndarray, sums: dict[tuple[int, int], int], counts: dict[int, int]) -> np.ndarray:
    """Componentwise floor of the means; empty clusters keep theirs."""
    out = old.copy()
    for (k, j), total in sums.items():
        out[k, j] = total // counts[k]
    return out


# ------------------------------------------------------------------ Spark
def integer_vectors(vectors: DataFrame, dimension: int, scale: int) -> DataFrame:
    whole = F.transform(F.col("embedding").cast("array<double>"), lambda v: F.floor(F.greatest(
        F.least(v * F.lit(float(scale)), F.lit(float(LARGEST))), F.lit(-float(LARGEST)))).cast("int"))
    good = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return (vectors.filter((F.size("embedding") == dimension) & good)
            .select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("x")))


def _first(dimension: int, centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"), dimension)
            yield _state(batch, x, (x * x).sum(axis=1), products(x, centroids), centroids)
    return run


def _next(dimension: int, centroids: np.ndarray, change: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"), dimension)
            dots = moved(_matrix(batch.column("dots"), len(centroids)), x, change)
            yield _state(batch, x, batch.column("norm").to_numpy(zero_copy_only=False), dots, centroids)
    return run


def _state(batch: pa.RecordBatch, x: np.ndarray, norm: np.ndarray, dots: np.ndarray, centroids: np.ndarray) -> pa.RecordBatch:
    best, distance = nearest(norm, dots, centroids)
    return pa.RecordBatch.from_arrays(
        [batch.column("vec_id"), _lists(x, pa.int32()), pa.array(norm, pa.int64()), _lists(dots, pa.int64()),
         pa.array(best, pa.int32()), pa.array(distance, pa.int64())],
        ["vec_id", "x", "norm", "dots", "cluster", "distance"])


def _sums(dimension: int, k: int):
    """Per task: count and componentwise sums of each of its clusters."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, dimension), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            x, of = _matrix(batch.column("x"), dimension), batch.column("cluster").to_numpy(zero_copy_only=False)
            order = np.argsort(of, kind="stable")
            first = np.flatnonzero(np.append(True, np.diff(of[order]) != 0)[:len(of)])
            if len(first):
                sums[of[order][first]] += np.add.reduceat(x[order], first, axis=0)
                counts += np.bincount(of, minlength=k)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(used, dimension), pa.int32()), pa.array(np.tile(np.arange(dimension), len(used)), pa.int32()),
             pa.array(np.repeat(counts[used], dimension), pa.int64()), pa.array(sums[used].ravel(), pa.int64())],
            ["cluster", "j", "n", "total"])
    return run


@dataclass
class Clustering:
    assigned: DataFrame        # vec_id, x, cluster, distance
    centroids: np.ndarray      # one row a cluster


def cluster(vectors: DataFrame, k: int, rounds: int, dimension: int, scale: int, seed: str) -> Clustering:
    """``rounds`` times assignment to the nearest centroid and replacement of
    the centroids by their means, then a last assignment.  The centroids start
    as the ``k`` vectors of smallest sha256 of ``seed`` and vec_id."""
    spark = vectors.sparkSession
    ints = integer_vectors(vectors, dimension, scale)
    start = (ints.withColumn("h", F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256))
             .orderBy(F.asc_nulls_last("h"), "vec_id", "x").limit(k).collect())
    centroids = np.array([r["x"] for r in start], np.int64).reshape(len(start), dimension)
    if not len(start):
        return Clustering(spark.createDataFrame([], STATE).select("vec_id", "x", "cluster", "distance"), centroids)
    folder = f"{checkpoint_root(spark).rstrip('/')}/centroids-{uuid.uuid4().hex}"
    path = f"{folder}/0"
    ints.mapInArrow(_first(dimension, centroids), STATE).write.parquet(path)
    for r in range(1, rounds + 1):
        state = spark.read.schema(STATE).parquet(path)
        rows = (state.select("cluster", "x").mapInArrow(_sums(dimension, len(centroids)), "cluster int, j int, n long, total long")
                .groupBy("cluster", "j").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect())
        new = means(centroids, {(x["cluster"], x["j"]): x["total"] for x in rows}, {x["cluster"]: x["n"] for x in rows})
        change = new - centroids
        if not change.any():
            break
        centroids, before, path = new, path, f"{folder}/{r}"
        state.mapInArrow(_next(dimension, centroids, change), STATE).write.parquet(path)
        delete(spark, before)
    return Clustering(spark.read.schema(STATE).parquet(path).select("vec_id", "x", "cluster", "distance"), centroids)
