"""Plan shape checks for scale: no pair-emitting joins, no Python UDFs,
map-side reduction before shuffles, pushed-down filters."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from repolens.operators.dedup import latest_per_key

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_no_pair_joins_or_python(spark, name):
    p = _plan(E.queries()[name](spark, SF))
    assert not [f for f in FORBIDDEN if f in p], p


def test_dedup_reduces_map_side(spark):
    p = _plan(E.queries()["stg_reviews"](spark, SF))
    assert "WindowGroupLimit" in p and "Partial" in p
    p = _plan(E.queries()["dsh_top_repos_per_language"](spark, SF))
    assert "Partial" in p


def test_high_water_filter_reaches_scan(spark):
    p = _plan(E.queries()["inc_since_commits"](spark, SF))
    assert "PushedFilters" in p and "author_date" in p.split("PushedFilters")[1][:300]


def test_hot_key_dedup(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [("hot", t0 + dt.timedelta(seconds=i), i) for i in range(10000)] + \
           [(f"k{i}", t0, i) for i in range(20000)]
    df = spark.createDataFrame(rows, "k string, ingestion_timestamp timestamp_ntz, v int").repartition(8)
    out = latest_per_key(df, ["k"], tie_breaks=["v"])
    assert out.count() == 20001
    assert out.filter(F.col("k") == "hot").collect()[0].v == 9999


def test_incremental_mark_prunes_day_partitions(spark, workdir):
    from repolens.operators import sinks
    from repolens.plans import staging
    from repolens.schemas import RAW_SCHEMAS
    t = dt.datetime
    rows = [(f"s{i}", "o/r", "a", "e", t(2024, 1, 1), "m", 1, 1, 1, t(2024, 1, 1 + i % 5, 2)) for i in range(50)]
    sinks.append_raw(spark.createDataFrame(rows, RAW_SCHEMAS["raw_commits"]), workdir, "raw_commits")
    raw = sinks.read_raw(spark, workdir, "raw_commits")
    q = staging.stg_commits(raw, since=t(2024, 1, 4))
    p = _plan(q)
    assert "PartitionFilters: [isnotnull(ingestion_date" in p and "ingestion_date" in p.split("PartitionFilters")[1][:200]
    assert q.count() == 20


def test_registered_incremental_query_pushes_mark(spark):
    p = _plan(E.queries()["inc_newer_than_target"](spark, SF))
    assert "PushedFilters: [IsNotNull(ingestion_timestamp), GreaterThan(ingestion_timestamp" in p


def test_language_bytes_are_summed_without_a_second_distinct_step(spark):
    """One row a (month, repository, language) is left, so no task holds a map of them again."""
    from repolens.plans.analytics import language_bytes_by_month
    t = dt.datetime
    rows = [("o/a", "Java", 5, t(2024, 1, 3)), ("o/a", "Java", 7, t(2024, 1, 9)), ("o/a", "Java", 9, t(2024, 2, 1)),
            ("o/b", "Java", 1, t(2024, 1, 3)), ("o/b", "Java", 1, t(2024, 1, 3)), (None, "Java", 2, t(2024, 1, 3)),
            ("o/a", None, 4, t(2024, 1, 3)), ("o/b", None, None, t(2024, 1, 3)), (None, "C", 3, t(2024, 1, 3))]
    raw = spark.createDataFrame(rows, "repo_full_name string, language_name string, byte_count long, ingestion_timestamp timestamp_ntz")
    out = language_bytes_by_month(raw)
    assert _plan(out).count("HashAggregate") == 2
    got = {(r.month_start.month, r.language_name): (r.bytes, r.repo_count) for r in out.collect()}
    assert got == {(1, "Java"): (10, 2), (2, "Java"): (9, 1), (1, None): (4, 2), (1, "C"): (3, 0)}


def test_joins_of_facts_carry_narrow_rows(spark):
    """Through the join with repositories go neither the reviews' composed keys nor the commits' whole messages."""
    lines = _plan(E.queries()["fct_reviews"](spark, SF)).splitlines()
    repo = max(i for i, x in enumerate(lines) if "Join" in x and "_repo_name" in x)
    assert max(i for i, x in enumerate(lines) if "concat(repo_full_name" in x) < repo
    lines = _plan(E.queries()["fct_commits"](spark, SF)).splitlines()
    repo = max(i for i, x in enumerate(lines) if "Join" in x and "_repo_name" in x)
    cut = max(i for i, x in enumerate(lines) if "commit_message" in x and "100" in x and "Project" in x)
    assert cut > repo


@pytest.mark.parametrize("name", ["inc_merge_reviews", "inc_backfill_reviews"])
def test_source_of_a_merge_is_shuffled_once(spark, name):
    """Its rows and its keys come from one shuffle, and the merged rows are looked up once."""
    df = E.queries()[name](spark, SF)
    df.collect()
    lines = _plan(df).split("Initial Plan")[0].splitlines()
    own = [x for x in lines if "Exchange hashpartitioning(id#" in x and "Reused" not in x]
    assert len(own) == 2 and sum("ReusedExchange" in x for x in lines) >= 1, "\n".join(lines)
    assert sum("Join" in x and "_repo_name" in x for x in lines) == 1
