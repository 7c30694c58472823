"""Tables behind a manifest: whole versions only, broken jobs, index of keys,
backfill, aggregates of touched months."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from repolens.operators import merge as M
from repolens.operators import sinks
from repolens.operators import versioned as V
from repolens.plans import refresh
from tests.jsonland import commit, pull, repository, review, write_page

DIM_END = dt.date(2027, 12, 31)
FACTS = ("fct_commits", "fct_pull_requests", "fct_reviews")


def frame(spark, rows):
    return spark.createDataFrame([(k, dt.datetime.fromisoformat(t) if t else None, v) for k, t, v in rows],
                                 "k string, at timestamp_ntz, v int")


def rows_of(df):
    return sorted(((r.k, r.at and r.at.isoformat()[:10], r.v) for r in df.collect()), key=str)


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_versions_are_whole_and_old_ones_go(spark, workdir):
    path = f"{workdir}/t"
    assert not V.exists(spark, path)
    with pytest.raises(FileNotFoundError):
        V.read(spark, path)
    for v in range(4):
        assert V.publish(spark, frame(spark, [("a", "2024-01-01", v)]), path) == v
    assert rows_of(V.read(spark, path)) == [("a", "2024-01-01", 3)]
    assert rows_of(V.read(spark, path, version=2)) == [("a", "2024-01-01", 2)]
    assert V.versions(spark, path) == [2, 3] and len(sinks.list_dirs(spark, f"{path}/data")) == 2
    empty = frame(spark, []).limit(0)
    V.publish(spark, empty, path)
    assert V.read(spark, path).count() == 0 and V.read(spark, path).columns == ["k", "at", "v"]


def test_a_failing_refresh_leaves_the_old_table(spark, workdir):
    path = f"{workdir}/t"
    V.publish(spark, frame(spark, [("a", "2024-01-01", 1)]), path)
    bad = frame(spark, [("b", "2024-01-01", 1)]).withColumn("v", F.raise_error(F.lit("broken")).cast("int"))
    with pytest.raises(Exception, match="broken"):
        V.publish(spark, bad, path)
    assert rows_of(V.read(spark, path)) == [("a", "2024-01-01", 1)]
    V.publish(spark, frame(spark, [("c", "2024-01-01", 1)]), path)     # stray folders do not disturb, and go
    V.publish(spark, frame(spark, [("d", "2024-01-01", 1)]), path)
    assert rows_of(V.read(spark, path)) == [("d", "2024-01-01", 1)]
    assert len(sinks.list_dirs(spark, f"{path}/data")) == 2


BASE = [("a", "2024-01-10", 1), ("b", "2024-02-10", 1), ("c", "2024-03-10", 1), ("d", "2024-04-10", 1), ("n", None, 1)]
DELTA = [("a", "2024-02-20", 2), ("e", "2024-02-21", 2), ("c", "2024-03-11", 2)]        # a moves, its month is emptied
AFTER = [("a", "2024-02-20", 2), ("b", "2024-02-10", 1), ("c", "2024-03-11", 2), ("d", "2024-04-10", 1),
         ("e", "2024-02-21", 2), ("n", None, 1)]


def test_a_merge_that_dies_between_months_shows_the_old_fact_whole(spark, workdir, monkeypatch):
    path = f"{workdir}/f"
    M.write_merged(spark, frame(spark, BASE), path, "k", "at")
    plain = V.commit

    def killed(spark, p, *rest):        # all folders of the new months are written, the manifest is not
        if p == path:
            raise RuntimeError("killed")
        return plain(spark, p, *rest)

    with monkeypatch.context() as m:
        m.setattr(V, "commit", killed)
        with pytest.raises(RuntimeError, match="killed"):
            M.write_merged(spark, frame(spark, DELTA), path, "k", "at")
    assert len(sinks.list_dirs(spark, f"{path}/data")) == 2
    assert rows_of(V.read(spark, path)) == sorted(BASE, key=str)
    rep = M.write_merged(spark, frame(spark, DELTA), path, "k", "at")
    assert rep["touched"] == ["2024-01", "2024-02", "2024-03"] and rep["emptied"] == ["2024-01"]
    assert rows_of(V.read(spark, path)) == AFTER
    M.write_merged(spark, frame(spark, DELTA), path, "k", "at")
    assert rows_of(V.read(spark, path)) == AFTER
    assert not os.listdir(f"{path}/_delta")


def test_a_merge_reads_and_writes_touched_months_only(spark, workdir, monkeypatch):
    path = f"{workdir}/f"
    M.write_merged(spark, frame(spark, BASE), path, "k", "at")
    before = {r["part"]: r["folder"] for r in V.entries(spark, path)}
    seen = []
    plain = V.read
    monkeypatch.setattr(V, "read", lambda spark, p, parts=None, version=None: (
        seen.append((p, parts)), plain(spark, p, parts, version))[1])
    M.write_merged(spark, frame(spark, DELTA), path, "k", "at")
    assert [p for p, _ in seen if p == path] == [path]
    assert [set(parts) for p, parts in seen if p == path] == [{"2024-01", "2024-02", "2024-03"}]
    assert all("/event_month=2024-03/" in f for f in plain(spark, path, ["2024-03"]).inputFiles())
    after = {r["part"]: r["folder"] for r in V.entries(spark, path)}
    assert after["2024-04"] == before["2024-04"] and after[None] == before[None]
    assert after["2024-03"] != before["2024-03"] and "2024-01" not in after
    # a key without a month moves into one
    M.write_merged(spark, frame(spark, [("n", "2024-04-01", 5)]), path, "k", "at")
    assert ("n", "2024-04-01", 5) in rows_of(plain(spark, path)) and plain(spark, path).count() == 6
    assert M.write_merged(spark, frame(spark, []).limit(0), path, "k", "at")["touched"] == []


def land(landing, day, commits, pulls, reviews, languages):
    write_page(landing, "repositories", [repository(1, "o/r"), repository(2, "o/s", "Go")], page=day)
    write_page(landing, "commits", commits, repo="o/r", page=day)
    write_page(landing, "pull_requests", pulls, repo="o/r", page=day)
    for pr, r in reviews.items():
        write_page(landing, "reviews", r, repo="o/r", pr=pr, page=day)
    write_page(landing, "languages", None, repo="o/r", page=day, raw_text=languages)


@pytest.fixture()
def root(spark, workdir):
    landing, root = f"{workdir}/l1", f"{workdir}/wh"
    land(landing, 1, [commit(f"c{m}", date=f"2024-0{m}-10T09:00:00Z") for m in range(1, 6)],
         [pull(m, created=f"2024-0{m}-01T00:00:00Z", updated=f"2024-0{m}-02T00:00:00Z") for m in range(1, 6)],
         {m: [review(10 + m, submitted=f"2024-0{m}-05T00:00:00Z")] for m in range(1, 6)}, '{"Java": 300, "Go": 5}')
    refresh.run_ingest(spark, landing, root, run_instant=dt.datetime(2024, 5, 12, 2))
    refresh.refresh_mart(spark, root, dim_end=DIM_END)
    return root


def all_rows(spark, root, names):
    return {n: sorted((tuple(r) for r in refresh.read_table(spark, root, "mart", n).collect()), key=str) for n in names}


AGGREGATES = ("agg_activity_day_repo", "agg_daily_activity", "agg_weekly_activity", "agg_monthly_activity",
              "agg_hourly_heatmap", "agg_language_usage")


def test_aggregates_follow_touched_months_only(spark, workdir, root, monkeypatch):
    landing = f"{workdir}/l2"
    land(landing, 2, [commit("c9", date="2024-05-20T23:00:00Z")], [], {}, '{"Java": 50, "Ruby": 7}')
    refresh.run_ingest(spark, landing, root, run_instant=dt.datetime(2024, 6, 21, 2))
    seen = []
    plain = V.read
    monkeypatch.setattr(V, "read", lambda spark, p, parts=None, version=None: (
        seen.append((p.rsplit("/", 1)[1], parts)), plain(spark, p, parts, version))[1])
    rep = refresh.refresh_mart(spark, root, dim_end=DIM_END)
    monkeypatch.undo()
    assert rep["aggregates"] == {"mode": "merge", "months": ["2024-05"]}
    facts = [x for x in seen[[n for n, _ in seen].index("fct_reviews"):] if x[0] in ("fct_commits",)]
    assert facts and all(list(parts) == ["2024-05"] for _, parts in facts)
    names = AGGREGATES + ("agg_commits_by_hour_month", "agg_language_bytes_month")
    kept = all_rows(spark, root, names)
    refresh.refresh_aggregates(spark, root)                 # from all rows
    assert all_rows(spark, root, names) == kept
    usage = {(str(r[0]), r[1]): r[2:] for r in kept["agg_language_usage"]}
    assert usage[("2024-05-01", "Java")][0] == 300 and usage[("2024-06-01", "Ruby")][0] == 7
    assert usage[("2024-05-01", "Java")][2] == 2


def test_backfill_restores_days_and_leaves_other_months_alone(spark, workdir, root):
    want = all_rows(spark, root, FACTS + AGGREGATES)
    for name in FACTS:
        # February's rows are lost, March's and January's spoilt; January is not asked for
        path, ts, key = f"{root}/mart/{name}", refresh.FACT_EVENT_TS[name], refresh.FACT_KEY[name]
        fact = refresh.read_table(spark, root, "mart", name).drop(M.EVENT_MONTH)
        spoilt = fact.filter(F.month(ts) != 2).withColumn(
            "ingestion_timestamp", F.when(~F.month(ts).isin(1, 3), F.col("ingestion_timestamp")))
        M.write_full(spark, spoilt, path, key, ts)
        before = {r["part"]: r["folder"] for r in V.entries(spark, path)}
        rep = refresh.backfill(spark, root, name, "2024-02-01", "2024-03-31", aggregates=name == "fct_commits")
        assert rep["touched"] == ["2024-02", "2024-03"]
        after = {r["part"]: r["folder"] for r in V.entries(spark, path)}
        assert all(after[m] == before[m] for m in ("2024-01", "2024-04", "2024-05"))
        lost = refresh.read_table(spark, root, "mart", name, ["2024-01"]).filter("ingestion_timestamp IS NULL").count()
        assert lost == 1
        refresh.backfill(spark, root, name, "2024-01-01", "2024-01-31", aggregates=False)
        one = refresh.backfill(spark, root, name, "2024-04-01", "2024-04-02", aggregates=False)      # the rest of the month stays
        assert set(one["touched"]) <= {"2024-04"}
    assert all_rows(spark, root, FACTS + AGGREGATES) == want
    # the fact has a row in the days, but its newest raw row lies in another month: it goes there
    path = f"{root}/mart/fct_commits"
    fact = refresh.read_table(spark, root, "mart", "fct_commits").drop(M.EVENT_MONTH)
    moved = fact.withColumn("committed_at", F.when(F.col("commit_sha") == "c4", F.lit("2024-02-03 00:00:00").cast("timestamp_ntz"))
                            .otherwise(F.col("committed_at")))
    M.write_full(spark, moved, path, "commit_sha", "committed_at")
    refresh.backfill(spark, root, "fct_commits", "2024-02-01", "2024-02-29", aggregates=False)
    assert all_rows(spark, root, ["fct_commits"]) == {"fct_commits": want["fct_commits"]}
