import datetime as dt

import pytest

from repolens.operators import incremental as INC
from repolens.operators import merge as M
from repolens.operators import versioned as V
from repolens.operators import runlog as RUN

TS = "sha string, author_date string"


def test_since_commits_keeps_newer_and_unknown(spark):
    df = spark.createDataFrame([("new", "2024-05-16T10:00:00Z"), ("old", "2024-05-14T10:00:00Z"),
                                ("none", None), ("junk", "not a date")], TS)
    kept = sorted(r.sha for r in INC.since_commits(df, dt.datetime(2024, 5, 15, 12)).collect())
    assert kept == ["junk", "new", "none"]
    # strictly after
    eq = spark.createDataFrame([("eq", "2024-05-15T12:00:00Z")], TS)
    assert INC.since_commits(eq, dt.datetime(2024, 5, 15, 12)).count() == 0
    assert INC.since_commits(df, None).count() == 4


def test_since_prs_and_review_scope(spark):
    prs = spark.createDataFrame([(1, "o/r", dt.datetime(2024, 5, 14)), (2, "o/r", dt.datetime(2024, 5, 16))],
                                "number bigint, repo_full_name string, updated_at timestamp_ntz")
    scoped = INC.since_pull_requests(prs, "2024-05-15 12:00:00")
    assert [r.number for r in scoped.collect()] == [2]
    reviews = spark.createDataFrame([(10, "o/r", 1), (20, "o/r", 2), (30, "o/x", 2)],
                                    "id bigint, repo_full_name string, pr_number bigint")
    assert [r.id for r in INC.reviews_in_scope(reviews, scoped).collect()] == [20]


def test_watermark_roundtrip(spark, workdir):
    assert INC.get_watermark(spark, workdir, "commits") is None
    INC.set_watermark(spark, workdir, "commits", dt.datetime(2024, 5, 1), now=dt.datetime(2024, 5, 2))
    INC.set_watermarks(spark, workdir, {"commits": dt.datetime(2024, 6, 1), "reviews": dt.datetime(2024, 6, 2)})
    assert INC.get_watermark(spark, workdir, "commits") == dt.datetime(2024, 6, 1)
    assert INC.get_watermark(spark, workdir, "reviews") == dt.datetime(2024, 6, 2)
    assert INC.read_watermarks(spark, workdir).count() == 2
    assert INC.get_watermark(spark, workdir, "languages") is None


def _log(spark, rows):
    return RUN.result_rows(spark, [(e, r, n, n, ok, err, 5) for e, r, n, ok, err in rows])


def test_gate_pr_failure_and_partial_commit_failure(spark):
    log = _log(spark, [("commits", "o/a", 10, True, None), ("commits", "o/b", 0, False, "boom"),
                       ("pull_requests", None, 0, False, "down"), ("reviews", "o/a", 0, True, None)])
    gate = {r.entityType: r.advance for r in INC.advanceable_entities(log).collect()}
    assert gate == {"commits": False, "pull_requests": False, "reviews": True}


def test_run_summaries(spark):
    log = _log(spark, [("commits", "o/a", 10, True, None), ("commits", "o/b", 5, True, None),
                       ("pull_requests", "o/a", 3, True, None), ("pull_requests", "o/b", 9, False, "x")])
    c = RUN.run_counts(log).collect()[0]
    assert (c.success_count, c.failure_count, c.has_failures) == (3, 1, True)
    by = {r.entityType: (r.extracted, r.loaded, r.failures) for r in RUN.run_by_entity(spark, log).collect()}
    assert by["commits"] == (15, 15, 0)
    assert by["pull_requests"] == (3, 3, 1)
    assert by["languages"] == (0, 0, 0)
    f = RUN.run_failures(log).collect()
    assert [(r.entityType, r.repoFullName, r.errorMessage) for r in f] == [("pull_requests", "o/b", "x")]


FACT = "k string, v string, ingestion_timestamp timestamp_ntz"


def test_newer_than_target_modes(spark):
    src = spark.createDataFrame([("a", "1", dt.datetime(2024, 1, 2)), ("b", "1", dt.datetime(2024, 1, 3))], FACT)
    tgt = spark.createDataFrame([("a", "0", dt.datetime(2024, 1, 2))], FACT)
    empty = spark.createDataFrame([], FACT)
    assert [r.k for r in M.newer_than_target(src, tgt).collect()] == ["b"]
    assert M.newer_than_target(src, None).count() == 2
    assert M.newer_than_target(src, empty).count() == 0          # reference quirk: nothing loads
    assert M.newer_than_target(src, empty, on_empty="all").count() == 2


def test_merge_into_semantics_and_idempotence(spark):
    tgt = spark.createDataFrame([("a", "old", None), ("b", "old", None), (None, "nullkey", None)], FACT)
    src = spark.createDataFrame([("a", "new", None), ("c", "new", None), (None, "srcnull", None)], FACT)
    out = M.merge_into(tgt, src, "k")
    got = sorted((r.k or "", r.v) for r in out.collect())
    assert got == [("", "nullkey"), ("", "srcnull"), ("a", "new"), ("b", "old"), ("c", "new")]
    again = sorted((r.k or "", r.v) for r in M.merge_into(out, src.filter("k is not null"), "k").collect())
    assert again == got


def test_merge_rejects_duplicate_source_keys(spark):
    tgt = spark.createDataFrame([], FACT)
    src = spark.createDataFrame([("a", "1", None), ("a", "2", None)], FACT)
    with pytest.raises(M.DuplicateKeyError):
        M.merge_into(tgt, src, "k", check_unique=True).count()


def test_backfill_replaces_only_range(spark):
    tgt = spark.createDataFrame([("a", "old", dt.datetime(2021, 3, 1)), ("b", "old", dt.datetime(2022, 3, 1))], FACT)
    rebuilt = spark.createDataFrame([("a", "new", dt.datetime(2021, 3, 1)), ("b", "new", dt.datetime(2022, 3, 1))],
                                    FACT)
    out = M.backfill(tgt, rebuilt, "k", "ingestion_timestamp", "2021-01-01", "2021-12-31")
    assert sorted((r.k, r.v) for r in out.collect()) == [("a", "new"), ("b", "old")]


def test_partition_scoped_merge_moves_key(spark, workdir):
    path = f"{workdir}/fct"
    schema = "k string, v string, ts timestamp_ntz"
    first = spark.createDataFrame([("a", "1", dt.datetime(2024, 1, 5)), ("b", "1", dt.datetime(2024, 2, 5))], schema)
    assert M.write_merged(spark, first, path, "k", "ts")["mode"] == "create"
    # key b moves from February to March; February becomes empty
    upd = spark.createDataFrame([("b", "2", dt.datetime(2024, 3, 5)), ("c", "2", dt.datetime(2024, 1, 9))], schema)
    rep = M.write_merged(spark, upd, path, "k", "ts")
    assert rep["emptied"] == ["2024-02"]
    out = V.read(spark, path)
    assert sorted((r.k, r.v, r.event_month) for r in out.collect()) == \
        [("a", "1", "2024-01"), ("b", "2", "2024-03"), ("c", "2", "2024-01")]
    # idempotent
    M.write_merged(spark, upd, path, "k", "ts")
    assert V.read(spark, path).count() == 3


def test_staged_rows_merge_as_their_facts_do(spark):
    """Also where repositories or pull requests repeat or are missing, and where keys, days or names are null."""
    from types import SimpleNamespace

    from repolens import queries_ops as ops
    from repolens.plans import mart
    from repolens.schemas import RAW_SCHEMAS
    t = dt.datetime
    repos = spark.createDataFrame([("o/a", 1), ("o/a", 2), ("o/b", 3)], "repo_full_name string, repo_id bigint")
    prs = spark.createDataFrame([("o/a#1",), ("o/a#1",), ("o/b#2",), (None,)], "pr_key string")
    w = SimpleNamespace(dim_repository=repos, dim_date=mart.dim_date(spark), fct_pull_requests=prs)

    def reviews(day, *rows):
        return spark.createDataFrame([(i, r, n, "u", f"s{day}", at, None, t(2024, 1, day)) for i, r, n, at in rows],
                                     RAW_SCHEMAS["raw_reviews"])
    a, b = t(2021, 3, 1), t(2022, 3, 1)
    old = reviews(1, (1, "o/a", 1, a), (2, "o/a", 9, a), (3, "o/b", 2, b), (4, None, 2, a), (5, "o/c", None, None), (6, "o/a", 1, b))
    new = reviews(2, (1, "o/b", 2, b), (2, "o/a", 1, a), (3, "o/a", None, None), (6, "o/a", 1, a), (7, "o/a", 1, a), (8, None, None, b))
    stg_old, stg_new = ops._staged("fct_reviews", old), ops._staged("fct_reviews", old.unionByName(new))

    def same(one, other):
        got = sorted(map(str, one.collect()))
        assert got == sorted(map(str, other.collect())) and len(got) > 8
    fact = lambda staged: ops._of_staged(w, "fct_reviews", staged)
    same(fact(M.merge_into(stg_old, stg_new, "review_id")), M.merge_into(fact(stg_old), fact(stg_new), "review_id"))
    days = "2021-01-01", "2021-12-31"
    same(fact(M.backfill(stg_old, stg_new, "review_id", "submitted_at", *days)),
         M.backfill(fact(stg_old), fact(stg_new), "review_id", "submitted_at", *days))
