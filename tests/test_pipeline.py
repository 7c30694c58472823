"""End to end: landed JSON -> raw tables -> staging -> mart, full and incremental."""

import datetime as dt

from pyspark.sql import functions as F

from repolens.operators import incremental as INC
from repolens.operators import sinks
from repolens.plans import refresh
from tests.jsonland import commit, pull, repository, review, write_page

DIM_END = dt.date(2027, 12, 31)


def _land_day1(landing):
    write_page(landing, "repositories", [repository(1, "octo/hello"), repository(2, "octo/world", "Go")])
    write_page(landing, "commits", [commit("c1", date="2024-05-10T09:00:00Z"),
                                    commit("c2", date="2024-05-11T09:00:00Z", stats=None)], repo="octo/hello")
    write_page(landing, "pull_requests", [pull(1, state="closed", created="2024-05-01T00:59:00Z",
                                               merged="2024-05-01T02:00:00Z", updated="2024-05-01T02:00:00Z"),
                                          pull(2, updated="2024-05-12T00:00:00Z")], repo="octo/hello")
    write_page(landing, "reviews", [review(10, state="approved")], repo="octo/hello", pr=1)
    write_page(landing, "reviews", [review(11, state="commented", body="ok")], repo="octo/hello", pr=2)
    write_page(landing, "languages", None, repo="octo/hello", raw_text='{"Java": 300, "Shell": 100}')


def _facts(spark, root):
    return {n: refresh.read_table(spark, root, "mart", n).drop("event_month")
            for n in ("fct_commits", "fct_pull_requests", "fct_reviews")}


def test_ingest_and_build(spark, workdir):
    landing, root = f"{workdir}/landing1", f"{workdir}/wh"
    _land_day1(landing)
    log = refresh.run_ingest(spark, landing, root, run_instant=dt.datetime(2024, 5, 12, 2))
    assert log.filter(~F.col("success")).count() == 0
    by = {(r.entityType, r.repoFullName): r.recordsLoaded for r in log.collect()}
    assert by[("commits", "octo/hello")] == 2 and by[("reviews", "octo/hello")] == 2
    assert INC.get_watermark(spark, root, "commits") == dt.datetime(2024, 5, 12, 2)
    raw = sinks.read_raw(spark, root, "raw_commits")
    assert raw.filter(F.col("ingestion_date") == F.lit("2024-05-12").cast("date")).count() == 2

    rep = refresh.refresh_mart(spark, root, dim_end=DIM_END)
    assert rep["fct_commits"]["mode"] == "full"
    f = _facts(spark, root)
    prs = {r.pr_key: r for r in f["fct_pull_requests"].collect()}
    assert prs["octo/hello#1"].state == "merged" and prs["octo/hello#1"].time_to_merge_hours == 1
    assert prs["octo/hello#1"].created_date_key == 20240501
    assert prs["octo/hello#2"].state == "open"
    rv = {r.review_id: r for r in f["fct_reviews"].collect()}
    assert rv[10].review_state == "APPROVED" and rv[10].pr_key == "octo/hello#1"
    cm = {r.commit_sha: r for r in f["fct_commits"].collect()}
    assert cm["c1"].total_changes == 180 and cm["c2"].total_changes == 0
    assert cm["c1"].repo_id is not None and cm["c1"].date_key == 20240510


def test_incremental_equals_full_and_is_idempotent(spark, workdir):
    landing1, landing2, root = f"{workdir}/l1", f"{workdir}/l2", f"{workdir}/wh"
    _land_day1(landing1)
    refresh.run_ingest(spark, landing1, root, run_instant=dt.datetime(2024, 5, 12, 2))
    refresh.refresh_mart(spark, root, dim_end=DIM_END)
    # day 2: PR 2 merged (moves state), new commit, old commit re-sent (filtered by watermark)
    write_page(landing2, "repositories", [repository(1, "octo/hello"), repository(2, "octo/world", "Go")])
    write_page(landing2, "commits", [commit("c1", date="2024-05-10T09:00:00Z"),
                                     commit("c3", date="2024-05-13T09:00:00Z", message="x" * 150)],
               repo="octo/hello")
    write_page(landing2, "pull_requests", [pull(2, state="closed", merged="2024-05-13T05:00:00Z",
                                                updated="2024-05-13T05:00:00Z")], repo="octo/hello")
    write_page(landing2, "reviews", [review(12, state="CHANGES_REQUESTED")], repo="octo/hello", pr=2)
    write_page(landing2, "languages", None, repo="octo/hello", raw_text='{"Java": 350}')
    log2 = refresh.run_ingest(spark, landing2, root, run_instant=dt.datetime(2024, 5, 13, 2))
    loaded = {(r.entityType, r.repoFullName): r.recordsLoaded for r in log2.collect()}
    assert loaded[("commits", "octo/hello")] == 1        # c1 is older than the commits watermark
    rep = refresh.refresh_mart(spark, root, dim_end=DIM_END)
    assert rep["fct_commits"]["mode"] == "merge"
    inc = {k: sorted(map(tuple, v.collect())) for k, v in _facts(spark, root).items()}
    # full rebuild from the same raw tables must give the same facts
    root_full = f"{workdir}/wh"
    refresh.refresh_mart(spark, root_full, dim_end=DIM_END, full_refresh=True)
    full = {k: sorted(map(tuple, v.collect())) for k, v in _facts(spark, root_full).items()}
    assert inc == full
    prs = {r.pr_key: r.state for r in _facts(spark, root)["fct_pull_requests"].collect()}
    assert prs["octo/hello#2"] == "merged"
    # idempotence: refreshing with no new raw rows changes nothing
    refresh.refresh_mart(spark, root, dim_end=DIM_END)
    again = {k: sorted(map(tuple, v.collect())) for k, v in _facts(spark, root).items()}
    assert again == full


def test_setup_failure_gives_infrastructure_row(spark, workdir):
    # a file where the warehouse folder should be makes setup fail
    bad_root = f"{workdir}/not_a_dir"
    with open(bad_root, "w") as fh:
        fh.write("x")
    log = refresh.run_ingest(spark, f"{workdir}/none", bad_root)
    rows = log.collect()
    assert len(rows) == 1 and rows[0].entityType == "infrastructure" and rows[0].success is False


def test_failed_entity_does_not_stop_others(spark, workdir):
    landing, root = f"{workdir}/l", f"{workdir}/wh"
    _land_day1(landing)
    import shutil
    shutil.rmtree(f"{landing}/pull_requests")             # PR step fails (path missing)
    log = refresh.run_ingest(spark, landing, root, run_instant=dt.datetime(2024, 5, 12, 2))
    res = {r.entityType: r.success for r in log.collect()}
    assert res["pull_requests"] is False and res["commits"] is True
    # without the PR list reviews are not loaded, which is a failure: their watermark stays
    assert res["reviews"] is False and INC.get_watermark(spark, root, "reviews") is None
    assert INC.get_watermark(spark, root, "pull_requests") is None
    assert INC.get_watermark(spark, root, "commits") == dt.datetime(2024, 5, 12, 2)
    log2 = refresh.run_ingest(spark, landing, f"{workdir}/wh2", reviews_need_prs=False)
    assert {r.entityType: r.success for r in log2.collect()}["reviews"] is True   # zero rows, reported as success


def test_full_mode_ignores_watermarks(spark, workdir):
    landing, root = f"{workdir}/l", f"{workdir}/wh"
    _land_day1(landing)
    refresh.run_ingest(spark, landing, root, run_instant=dt.datetime(2024, 5, 12, 2))
    inc = refresh.run_ingest(spark, landing, root, run_instant=dt.datetime(2024, 5, 13, 2))
    loaded = {(r.entityType, r.repoFullName): r.recordsLoaded for r in inc.collect()}
    assert loaded[("commits", "octo/hello")] == 0           # no file is new
    write_page(landing, "commits", [commit("c0", date="2024-05-11T00:00:00Z")], repo="octo/hello", page=2)
    inc = refresh.run_ingest(spark, landing, root, run_instant=dt.datetime(2024, 5, 13, 3))
    loaded = {(r.entityType, r.repoFullName): r.recordsLoaded for r in inc.collect()}
    assert loaded[("commits", "octo/hello")] == 0           # a new file, its commit is older than the watermark
    full = refresh.run_ingest(spark, landing, root, full=True, run_instant=dt.datetime(2024, 5, 14, 2))
    loaded = {(r.entityType, r.repoFullName): r.recordsLoaded for r in full.collect()}
    assert loaded[("commits", "octo/hello")] == 3
    assert INC.get_watermark(spark, root, "commits") == dt.datetime(2024, 5, 14, 2)   # still advanced


def test_malformed_page_fails_only_its_entity(spark, workdir):
    landing, root = f"{workdir}/l", f"{workdir}/wh"
    _land_day1(landing)
    write_page(landing, "pull_requests", None, repo="octo/hello", page=2, raw_text='[{"number": 3, "title": ')
    log = refresh.run_ingest(spark, landing, root, run_instant=dt.datetime(2024, 5, 12, 2))
    failed = {(r.entityType, r.repoFullName) for r in log.collect() if not r.success}
    assert failed == {("pull_requests", "octo/hello"), ("reviews", "octo/hello")}
    assert sinks.read_raw(spark, root, "raw_pull_requests").count() == 0


def test_refresh_writes_aggregate_tables(spark, workdir):
    landing, root = f"{workdir}/l", f"{workdir}/wh"
    _land_day1(landing)
    refresh.run_ingest(spark, landing, root, run_instant=dt.datetime(2024, 5, 12, 2))
    refresh.refresh_mart(spark, root, dim_end=DIM_END)
    daily = {r.activity_date: r for r in refresh.read_table(spark, root, "mart", "agg_daily_activity").collect()}
    assert daily[dt.date(2024, 5, 10)].commits == 1 and daily[dt.date(2024, 5, 1)].prs_created == 2
    assert refresh.read_table(spark, root, "mart", "agg_hourly_heatmap").count() == 168
    lang = refresh.read_table(spark, root, "mart", "agg_language_usage").collect()
    assert {(r.language_name, r.bytes) for r in lang if r.bytes} == {("Java", 300), ("Shell", 100)}
