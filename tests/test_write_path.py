"""The write path keeps rows: rejected ones, newest snapshots, hot keys, merges."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from repolens.functions.scalar import utc_wallclock
from repolens.operators import dedup, ingest, merge, runlog, sinks, versioned
from repolens.schemas import RAW_SCHEMAS

T0 = dt.datetime(2024, 5, 12, 2)


def raw(spark, table, rows):
    schema = RAW_SCHEMAS[table]
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)


def test_rejected_rows_are_kept_with_reasons_and_not_counted_as_loaded(spark, workdir):
    df = raw(spark, "raw_commits", [{"sha": "a", "repo_full_name": "o/r", "ingestion_timestamp": T0},
                                    {"sha": None, "repo_full_name": "o/r", "ingestion_timestamp": T0}])
    ok, bad = ingest.split_valid(df, "raw_commits")
    sinks.append_raw(ok, workdir, "raw_commits")
    sinks.append_rejected(bad, workdir, "raw_commits")
    kept = sinks.read_rejected(spark, workdir, "raw_commits").collect()
    assert [(r.repo_full_name, r.errors) for r in kept] == [("o/r", ["required field sha is null"])]
    assert sinks.read_raw(spark, workdir, "raw_commits").count() == 1
    assert sinks.read_rejected(spark, workdir, "raw_reviews").count() == 0
    m = ingest.load_metrics(df, "raw_commits", by=["repo_full_name"])
    row = runlog.results_from_metrics(m, "commits").first()
    assert (row.recordsExtracted, row.recordsLoaded) == (2, 1)
    assert dict(runlog.results_from_metrics(m, "commits").dtypes)["recordsLoaded"] == "bigint"


def test_of_two_snapshots_in_one_batch_the_later_update_wins(spark):
    rows = [{"number": 1, "repo_full_name": "o/r", "state": "open", "updated_at": dt.datetime(2024, 5, 1), "ingestion_timestamp": T0},
            {"number": 1, "repo_full_name": "o/r", "state": "closed", "updated_at": dt.datetime(2024, 5, 2),
             "merged_at": dt.datetime(2024, 5, 2), "ingestion_timestamp": T0}]
    df = raw(spark, "raw_pull_requests", rows)
    keys = ["repo_full_name", "number"]
    got = dedup.latest_per_key(df, keys, tie_breaks=dedup.tie_breaks_for(df, keys)).collect()
    assert [r.state for r in got] == ["closed"]


def test_a_hot_cluster_key_is_cut_into_ranges(spark):
    df = spark.range(30_000).select(
        F.sha1(F.col("id").cast("string")).alias("sha"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("r"), (F.col("id") % 997).cast("string"))).alias("repo_full_name"),
        F.lit(T0).cast("timestamp_ntz").alias("ingestion_timestamp"))
    sizes = [r["count"] for r in sinks.clustered(sinks.with_partition_column(df), "raw_commits", 8)
             .groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 30_000 and max(sizes) < 2 * 30_000 / 8


def test_merge_refuses_duplicate_keys(spark, workdir):
    path = f"{workdir}/fct"
    one = spark.createDataFrame([("a", dt.datetime(2024, 1, 1))], "k string, at timestamp_ntz")
    merge.write_merged(spark, one, path, "k", "at")
    with pytest.raises(merge.DuplicateKeyError):
        merge.write_merged(spark, one.unionByName(one), path, "k", "at")
    assert versioned.read(spark, path).count() == 1


def test_wall_clock_does_not_pass_through_the_session_zone(spark):
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "America/New_York")
    rows = ["2023-11-05T06:30:00Z", "2023-11-05T05:30:00Z", "2024-03-10T02:30:00", "2024-01-01T00:00:00.123456+02:00",
            "2024-01-01", "junk", None]
    df = other.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, x string")
    got = [r.t for r in df.select("i", utc_wallclock("x").alias("t")).orderBy("i").collect()]
    assert got == [dt.datetime(2023, 11, 5, 6, 30), dt.datetime(2023, 11, 5, 5, 30), dt.datetime(2024, 3, 10, 2, 30),
                   dt.datetime(2023, 12, 31, 22, 0, 0, 123456), dt.datetime(2024, 1, 1), None, None]
