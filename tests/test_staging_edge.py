"""Staging and mart semantics on hand-built rows (cases the derived
fixture does not contain)."""

import datetime as dt

from pyspark.sql import functions as F

from repolens.operators.dedup import latest_per_key
from repolens.plans import mart, staging
from repolens.schemas import RAW_SCHEMAS

T0 = dt.datetime(2024, 1, 1)
T1 = dt.datetime(2024, 1, 2)


def _raw(spark, table, rows):
    return spark.createDataFrame(rows, RAW_SCHEMAS[table])


def test_commit_string_dates_safe_cast(spark):
    df = spark.createDataFrame([("a", "2024-01-07 23:30:00", T0), ("b", "garbage", T0)],
                               "sha string, author_date string, ingestion_timestamp timestamp_ntz")
    for c in ("repo_full_name", "author_name", "author_email", "message"):
        df = df.withColumn(c, F.lit(None).cast("string"))
    for c in ("additions", "deletions", "changed_files"):
        df = df.withColumn(c, F.lit(None).cast("bigint"))
    rows = {r.commit_sha: r for r in staging.stg_commits(df).collect()}
    a = rows["a"]
    assert (a.hour_of_day, a.day_of_week, a.iso_week, a.month, a.year) == (23, 1, 1, 1, 2024)  # Sunday
    assert rows["b"].authored_at is None and rows["b"].hour_of_day is None


def test_iso_week_53_with_calendar_year(spark):
    df = _raw(spark, "raw_commits", [("x", "r/x", None, None, dt.datetime(2021, 1, 1, 12), "m", 1, 1, 1, T0)])
    r = staging.stg_commits(df).collect()[0]
    assert (r.iso_week, r.year, r.day_of_week) == (53, 2021, 6)


def test_pr_state_rules_and_whole_hours(spark):
    rows = [
        (1, "o/r", "t", "open", "u", dt.datetime(2024, 1, 1, 0, 59), None, dt.datetime(2024, 1, 1, 2, 0), "s", T0),
        (2, "o/r", "t", "CLOSED", "u", T0, None, None, None, T0),
        (3, "o/r", "t", None, "u", T0, None, None, None, T0),
        (4, "o/r", "t", "weird", "u", T0, None, None, None, T0),
    ]
    out = {r.pr_number: r for r in staging.stg_pull_requests(_raw(spark, "raw_pull_requests", rows)).collect()}
    assert out[1].state == "merged" and out[1].is_merged and out[1].time_to_merge_hours == 1
    assert out[2].state == "closed" and out[2].time_to_merge_hours is None
    assert out[3].state == "open" and out[4].state == "open"
    assert out[1].pr_id == "o/r-1"


def test_review_state_upper_passes_unknown(spark):
    rows = [(1, "o/r", 5, "u", "pending", T0, None, T0), (2, "o/r", 5, "u", "Changes_Requested", T0, "b", T0)]
    out = {r.review_id: r.review_state for r in staging.stg_reviews(_raw(spark, "raw_reviews", rows)).collect()}
    assert out == {1: "PENDING", 2: "CHANGES_REQUESTED"}


def test_owner_without_slash_and_dedup_latest(spark):
    rows = [(1, "n", "noslash", "o", "Go", T0, T0, "public", False, 1, T0),
            (1, "n", "noslash", "o", "Rust", T0, T1, "public", False, 2, T1)]
    out = staging.stg_repositories(_raw(spark, "raw_repositories", rows)).collect()
    assert len(out) == 1 and out[0].owner == "noslash" and out[0].primary_language == "Rust"


def test_language_share_zero_total_and_dead_languages(spark):
    rows = [("o/a", "Java", 0, T0), ("o/a", "C", 0, T0),
            ("o/b", "Java", 30, T0), ("o/b", "C", 10, T0), ("o/b", "Java", 60, T1)]
    out = {(r.repo_full_name, r.language_name): r.language_percentage
           for r in staging.stg_languages(_raw(spark, "raw_languages", rows)).collect()}
    assert out[("o/a", "Java")] is None
    # C keeps its old snapshot next to Java's newer one
    assert out[("o/b", "Java")] == 60 / 70 and out[("o/b", "C")] == 10 / 70


def test_dedup_ties_deterministic_under_repartition(spark):
    rows = [(1, "o/r", 5, "u1", "A", T0, "x", T1), (1, "o/r", 5, "u2", "A", T0, "y", T1),
            (1, "o/r", 5, "u0", "A", T0, None, T1)]
    df = _raw(spark, "raw_reviews", rows)
    results = set()
    for n in (1, 3, 7):
        r = staging.stg_reviews(df.repartition(n)).collect()[0]
        results.add((r.reviewer_login, r.review_body))
    assert results == {("u2", "y")}


def test_latest_per_key_composite(spark):
    df = spark.createDataFrame([("a", 1, T0, "old"), ("a", 1, T1, "new"), ("a", 2, T0, "other")],
                               "r string, n int, ingestion_timestamp timestamp_ntz, v string")
    out = sorted((x.r, x.n, x.v) for x in latest_per_key(df, ["r", "n"]).collect())
    assert out == [("a", 1, "new"), ("a", 2, "other")]


def test_facts_outside_dimension_and_missing_pr(spark):
    dim_dt = mart.dim_date(spark, "2020-01-01", "2020-12-31")
    assert dim_dt.count() == 366
    repos = staging.stg_repositories(_raw(spark, "raw_repositories", [
        (1, "r", "o/r", "o", "Go", T0, T0, "public", False, 1, T0)]))
    dim_repo = mart.dim_repository(repos)
    c = staging.stg_commits(_raw(spark, "raw_commits", [
        ("x", "o/r", "d", "e", dt.datetime(2024, 5, 1), "é" * 150, None, 3, 0, T0)]))
    f = mart.fct_commits(c, dim_repo, dim_dt).collect()[0]
    assert f.date_key is None and f.repo_id is not None
    assert len(f.message_first_line) == 100 and f.total_changes == 3
    rv = staging.stg_reviews(_raw(spark, "raw_reviews", [(9, "o/r", 77, "u", "APPROVED", T0, None, T0)]))
    prs = spark.createDataFrame([], "pr_key string")
    r = mart.fct_reviews(rv, dim_repo, dim_dt, prs).collect()[0]
    assert r.pr_key is None and r.date_key is None


def test_dim_date_attributes(spark):
    d = {r.full_date: r for r in mart.dim_date(spark, "2024-12-28", "2025-01-01").collect()}
    r = d[dt.date(2024, 12, 30)]
    assert (r.date_key, r.day_of_week, r.day_name, r.iso_week_number, r.month_name, r.quarter, r.is_weekend) == \
        (20241230, 2, "Monday", 1, "December", 4, False)
    assert d[dt.date(2024, 12, 28)].is_weekend


def test_register_staging_views(spark):
    raw = {t: spark.createDataFrame([], RAW_SCHEMAS[t]) for t in RAW_SCHEMAS}
    out = staging.register_staging(raw)
    assert set(out) == {"stg_commits", "stg_pull_requests", "stg_reviews", "stg_repositories", "stg_languages"}
    assert spark.sql("SELECT count(*) AS n FROM stg_commits").collect()[0].n == 0
    assert "pr_id" in spark.table("stg_pull_requests").columns


def test_dim_date_default_end_is_today_plus_365(spark):
    d = mart.dim_date(spark)
    r = d.agg(F.min("full_date").alias("lo"), F.max("full_date").alias("hi"), F.count(F.lit(1)).alias("n")).collect()[0]
    today = spark.range(1).select(F.current_date().alias("t")).collect()[0].t
    assert r.lo == dt.date(2020, 1, 1) and r.hi == today + dt.timedelta(days=365)
    assert r.n == (r.hi - r.lo).days + 1
