"""Incremental facts: high-water predicate, merge by unique key, and the
partition-scoped write that persists a merge on plain parquet.

Parquet has no row-level MERGE, so a merge is computed as
``target ANTI JOIN source ON key  UNION ALL  source`` over the month
partitions that it touches; these are written to new folders and published
with one manifest (``operators.versioned``): readers see the merge whole or
not at all.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import CODEC, shuffles_dropped
from . import sinks
from . import versioned as V

EVENT_MONTH = "event_month"
BUCKET, BUCKETS = "key_bucket", 64     # of the index of keys


class DuplicateKeyError(ValueError):
    pass


def high_water_mark(target: DataFrame | None, col: str = "ingestion_timestamp"):
    """INC-08 (scalar part): ``max(col)`` of the target, collected as one value.

    Returns ``("absent", None)`` when there is no target (first build: take
    everything), ``("empty", None)`` for an existing but empty target, and
    ``("mark", ts)`` otherwise.
    """
    if target is None:
        return "absent", None
    v = target.agg(F.max(col).alias("m")).first()["m"]
    return ("empty", None) if v is None else ("mark", v)


def newer_than_target(src: DataFrame, target: DataFrame | None, col: str = "ingestion_timestamp",
                      on_empty: str = "none") -> DataFrame:
    """INC-08: rows of ``src`` strictly newer than the target's newest row.

    The mark is a literal, so Catalyst can push it into scans and prune day
    partitions.  With an existing but *empty* target the reference's
    ``> max(...)`` compares with NULL and loads nothing; ``on_empty="all"``
    loads everything instead.
    """
    state, mark = high_water_mark(target, col)
    if state == "absent":
        return src
    if state == "empty":
        return src if on_empty == "all" else src.limit(0)
    return src.filter(F.col(col) > F.lit(mark))


def assert_unique_keys(src: DataFrame, key: Sequence[str] | str) -> None:
    """Duplicate source keys make a merge ambiguous: raise instead."""
    keys = [key] if isinstance(key, str) else list(key)
    dup = src.groupBy(*keys).count().filter("count > 1").limit(1).collect()
    if dup:
        raise DuplicateKeyError(f"duplicate merge key in source: {dup[0].asDict()}")


def merge_into(target: DataFrame, src: DataFrame, key: Sequence[str] | str, check_unique: bool = False) -> DataFrame:
    """INC-09: matched rows are replaced whole, unmatched source rows are
    inserted; NULL keys never match (the anti join keeps NULL-key target
    rows and the source's NULL-key rows are inserted).  Idempotent:
    merging the same source twice gives the same result."""
    keys = [key] if isinstance(key, str) else list(key)
    if check_unique:
        assert_unique_keys(src, keys)
    kept = target.join(src.select(*keys), keys, "left_anti")
    return kept.unionByName(src)


def backfill(target: DataFrame, rebuilt: DataFrame, key, date_col: str, start, end) -> DataFrame:
    """INC-10: recompute the facts whose ``date_col`` falls in [start, end]
    (inclusive days) from the source and merge them into the target."""
    d = F.to_date(F.col(date_col))
    part = rebuilt.filter((d >= F.lit(str(start)).cast("date")) & (d <= F.lit(str(end)).cast("date")))
    return merge_into(target, part, key)


def with_event_month(df: DataFrame, ts_col: str) -> DataFrame:
    return df.withColumn(EVENT_MONTH, F.date_format(F.col(ts_col), "yyyy-MM"))


def for_month_write(df: DataFrame, key: str) -> DataFrame:
    """Range-partition by (month, key) before a partitioned write, so each
    task writes one or two month folders (files ~ tasks + months rather
    than tasks x months); a hot month is spread over several ranges."""
    return df.repartitionByRange(F.col(EVENT_MONTH), F.col(key))


# ------------------------------------------------------------------ index of keys
def key_index_path(path: str) -> str:
    return f"{path.rstrip('/')}/_keys"


def _keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(F.col(key), EVENT_MONTH, F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("string").alias(BUCKET))


def add_keys(spark: SparkSession, df: DataFrame, path: str, key: str, anew: bool = False) -> None:
    """Add the (key, month) pairs of ``df`` to the index of the fact at
    ``path`` (``anew``: make it of them alone).  The index only has to hold
    every pair of the fact; one that is no longer true makes a merge look at
    one month more, so it is added to before a version is published and made
    anew, in one commit, only after a full build."""
    out = _keys(df, key).repartition(BUCKET)
    V.publish(spark, out, key_index_path(path), BUCKET, None if anew else ())


def months_of_keys(spark: SparkSession, df: DataFrame, path: str, key: str) -> list:
    """Months in which the fact at ``path`` may hold keys of ``df``, from the
    buckets of the index that these keys fall in; the fact is not read."""
    mine = _keys(df, key)
    buckets = [r[0] for r in mine.select(BUCKET).distinct().collect()]      # BUCKETS at most
    index = V.read(spark, key_index_path(path), buckets)
    # one value a month
    return [r[0] for r in index.join(mine.select(key), key, "left_semi").select(EVENT_MONTH).distinct().collect()]


# ------------------------------------------------------------------ writes
def write_full(spark: SparkSession, src: DataFrame, path: str, key: str, ts_col: str) -> dict:
    """Publish ``src`` as the whole fact, and the index of its keys."""
    staged = V.stage(spark, for_month_write(with_event_month(src, ts_col), key), path, EVENT_MONTH)
    if V.exists(spark, path):       # keys of both until the new version is published
        add_keys(spark, V.read_staged(spark, path, staged), path, key)
    V.commit(spark, path, staged)
    add_keys(spark, V.read(spark, path), path, key, anew=True)
    return {"mode": "full"}


def write_merged(spark: SparkSession, src: DataFrame, path: str, key: str, ts_col: str) -> dict:
    """Persist ``merge_into(existing, src)`` by writing only the touched
    month partitions of the fact table at ``path`` and publishing them in one
    commit.

    Touched months = months of the new rows plus months where their keys
    may live (a key whose event month moved must leave its old partition);
    the latter come from the index of keys, so other months are not read at
    all.  The delta is written once beside the table and removed at the end;
    its keys must be unique, or the merge would write a key twice.
    """
    delta_path = f"{path.rstrip('/')}/_delta/{uuid.uuid4().hex}"
    try:
        src = with_event_month(src, ts_col)
        with shuffles_dropped(spark):
            src.write.option("compression", CODEC).parquet(delta_path)
        delta = spark.read.schema(src.schema).parquet(delta_path)
        assert_unique_keys(delta, key)
        if not V.exists(spark, path):
            return write_full(spark, delta.drop(EVENT_MONTH), path, key, ts_col) | {"mode": "create"}
        touched = {r[0] for r in delta.select(EVENT_MONTH).distinct().collect()}    # one value a month
        touched |= set(months_of_keys(spark, delta, path, key))
        if not touched:
            return {"mode": "merge", "touched": [], "emptied": [], "version": V.versions(spark, path)[-1]}
        add_keys(spark, delta, path, key)
        affected = V.read(spark, path, touched)
        merged = merge_into(affected, delta.select(*affected.columns), key)
        version = V.publish(spark, for_month_write(merged, key), path, EVENT_MONTH, replace=touched)
        present = {r["part"] for r in V.entries(spark, path, version)}
        return {"mode": "merge", "touched": sorted(touched, key=str), "emptied": sorted(touched - present, key=str),
                "version": version}
    finally:
        sinks.delete(spark, delta_path)
