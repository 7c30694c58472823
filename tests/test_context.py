"""The warehouse builds the tables that are asked for and what they need, whole or not at all."""

import time

import pytest

import __spark_entry__ as E
from repolens import context
from repolens.operators import sinks
from repolens.operators import versioned as V
from repolens.session import shuffles_dropped

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def fresh(spark, workdir):
    spark.conf.set(context.WAREHOUSE_DIR_CONF, f"{workdir}/wh")
    yield f"{workdir}/wh"
    spark.conf.unset(context.WAREHOUSE_DIR_CONF)


def tables(spark, base):
    return {t for root in sinks.list_dirs(spark, base) for t in sinks.list_dirs(spark, f"{base}/{root}")}


def test_needs_names_what_build_reads(spark, monkeypatch):
    w = context.Warehouse(spark, SF, materialize=False)
    read, lazy = set(), w.table
    monkeypatch.setattr(w, "table", lambda name, partitioned=False: read.add(name) or lazy(name))
    for name in context.LAYERS:
        w._lazy = {t: w._lazy[t] for t in w._lazy if t != name}
        for t in context.NEEDS.get(name, ()):
            lazy(t)
        read.clear()
        w.build(name)
        assert read == set(context.NEEDS.get(name, ())), name


def test_a_query_builds_only_what_it_needs(spark, fresh):
    assert E.queries()["agg_languages_pivot"](spark, SF).count() > 0
    assert tables(spark, fresh) == {"raw_languages", "stg_languages"}
    E.queries()["dsh_merge_time_buckets"](spark, SF).collect()
    prs = {"raw_languages", "stg_languages", "raw_repositories", "raw_pull_requests", "stg_repositories",
           "stg_pull_requests", "dim_repository", "dim_date", "fct_pull_requests"}
    assert tables(spark, fresh) == prs
    w = context.Warehouse(spark, SF)
    w.ensure_materialized()
    assert tables(spark, fresh) == set(context.LAYERS)


def test_a_broken_build_leaves_whole_tables_only(spark, fresh, monkeypatch):
    build = context.Warehouse.build
    monkeypatch.setattr(context.Warehouse, "build",
                        lambda self, name: 1 / 0 if name == "stg_languages" else build(self, name))
    w = context.Warehouse(spark, SF)
    with pytest.raises(ZeroDivisionError):
        w.table("stg_languages")
    assert tables(spark, fresh) == {"raw_languages"} and len(sinks.list_dirs(spark, fresh)) == 1
    monkeypatch.undo()
    assert w.table("stg_languages").count() > 0
    assert tables(spark, fresh) == {"raw_languages", "stg_languages"}


@pytest.mark.parametrize("name", ["inc_backfill_reviews", "inc_written_backfill_reviews"])
def test_backfill_builds_no_whole_fact(spark, fresh, name):
    """The days are rebuilt from the raw rows, so neither the whole history's staged reviews nor their fact is written."""
    assert E.queries()[name](spark, SF).count() > 0
    assert {"raw_reviews", "fct_pull_requests"} <= tables(spark, fresh)
    assert not {"stg_reviews", "fct_reviews"} & tables(spark, fresh)


def shuffles(spark):
    """Numbers of the shuffles that have files."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    out = set()
    while files.hasNext():
        name = files.next().getName()
        if name.startswith("shuffle_"):
            out.add(int(name.split("_")[1]))
    return out


def test_written_tables_leave_no_shuffle_files(spark, fresh):
    before = shuffles(spark)
    context.Warehouse(spark, SF).ensure("fct_reviews")
    V.publish(spark, spark.range(1000).repartition(3, "id"), f"{fresh}/t")
    until = time.monotonic() + 20       # files go soon after a write, not within it
    while left := shuffles(spark) - before:
        assert time.monotonic() < until, left
        time.sleep(0.2)


def test_shuffles_dropped_puts_the_setting_back(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    for value in (None, "false", "true"):
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)
        with pytest.raises(ZeroDivisionError), shuffles_dropped(spark):
            with shuffles_dropped(spark):
                assert spark.conf.get(key) == "true"
            assert spark.conf.get(key) == "true"
            1 / 0
        assert spark.conf.get(key, None) == value
    spark.conf.unset(key)
