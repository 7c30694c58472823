import datetime as dt


import pytest
from repolens.operators import ingest as ING
from repolens.sources import landing as L
from tests.jsonland import commit, pull, repository, review, write_page


def test_repository_unknown_field_ignored(spark, workdir):
    write_page(workdir, "repositories", [repository(1, "octo/hello", extra=True)])
    df = ING.to_raw_repositories(L.read_repositories_json(spark, workdir))
    r = df.collect()[0]
    assert (r.id, r.full_name, r.owner_login, r.language, r.fork, r.stargazers_count) == \
        (1, "octo/hello", "octo", "Java", False, 7)
    assert r.created_at == dt.datetime(2021, 1, 1)


def test_commit_flatten_and_stats_mapping(spark, workdir):
    write_page(workdir, "commits", [commit("a1"), commit("a2", stats=None)], repo="octo/hello")
    raw = ING.to_raw_commits(L.read_commits_json(spark, workdir))
    rows = {r.sha: r for r in raw.collect()}
    a1 = rows["a1"]
    # changed_files is stats.total (150 + 30), not a file count
    assert (a1.additions, a1.deletions, a1.changed_files) == (150, 30, 180)
    assert a1.repo_full_name == "octo/hello" and a1.author_name == "Ann"
    assert a1.author_date == dt.datetime(2024, 5, 16, 10, 0)
    # no stats object -> NULL columns
    assert (rows["a2"].additions, rows["a2"].changed_files) == (None, None)


def test_commit_missing_number_inside_present_object_is_zero(spark, workdir):
    write_page(workdir, "commits", [], repo="r/x",
               raw_text='[{"sha": "z", "stats": {"additions": 5}}]')
    r = ING.to_raw_commits(L.read_commits_json(spark, workdir)).collect()[0]
    assert (r.additions, r.deletions, r.changed_files) == (5, 0, 0)
    assert r.author_name is None and r.message is None


def test_commit_author_filter(spark, workdir):
    write_page(workdir, "commits", [commit("a1", login="ann"), commit("b1", login="bo")], repo="o/r")
    assert [r.sha for r in L.read_commits_json(spark, workdir, author_login="bo").collect()] == ["b1"]


def test_two_pages_and_empty_page_concatenate(spark, workdir):
    write_page(workdir, "commits", [commit("p1")], repo="o/r", page=1)
    write_page(workdir, "commits", [commit("p2")], repo="o/r", page=2)
    write_page(workdir, "commits", [], repo="o/r", page=3)
    assert sorted(r.sha for r in L.read_commits_json(spark, workdir).collect()) == ["p1", "p2"]


def test_pull_requests_merged_and_not(spark, workdir):
    write_page(workdir, "pull_requests",
               [pull(1, state="closed", merged="2024-05-02T01:00:00Z"), pull(2)], repo="o/r")
    raw = ING.to_raw_pull_requests(L.read_pull_requests_json(spark, workdir))
    rows = {r.number: r for r in raw.collect()}
    assert rows[1].merged_at == dt.datetime(2024, 5, 2, 1) and rows[1].merge_commit_sha == "abc"
    assert rows[2].merged_at is None and rows[2].user_login == "bob"


def test_review_tagged_from_path(spark, workdir):
    write_page(workdir, "reviews", [review(77)], repo="o/r", pr=5)
    r = ING.to_raw_reviews(L.read_reviews_json(spark, workdir)).collect()[0]
    assert (r.id, r.repo_full_name, r.pr_number, r.state, r.body, r.user_login) == \
        (77, "o/r", 5, "APPROVED", None, "cat")


def test_languages_map_and_null_map(spark, workdir):
    write_page(workdir, "languages", None, repo="o/a", raw_text='{"Java":125000,"Python":45000,"Shell":3200}')
    write_page(workdir, "languages", None, repo="o/b", raw_text="null")
    write_page(workdir, "languages", None, repo="o/c", raw_text="{}")
    raw = ING.to_raw_languages(L.read_languages_json(spark, workdir))
    rows = sorted((r.repo_full_name, r.language_name, r.byte_count) for r in raw.collect())
    assert rows == [("o/a", "Java", 125000), ("o/a", "Python", 45000), ("o/a", "Shell", 3200)]


def test_stamp_overwrites(spark):
    df = spark.createDataFrame([("a", dt.datetime(2000, 1, 1))], "sha string, ingestion_timestamp timestamp_ntz")
    out = ING.stamp(df, dt.datetime(2024, 2, 1, 2)).collect()[0]
    assert out.ingestion_timestamp == dt.datetime(2024, 2, 1, 2)


def _commits(spark, shas):
    return spark.createDataFrame([(s, dt.datetime(2024, 1, 1)) for s in shas],
                                 "sha string, ingestion_timestamp timestamp_ntz")


def test_split_valid_and_metrics(spark):
    df = _commits(spark, ["a", None, "c"])
    ok, bad = ING.split_valid(df, "raw_commits")
    assert ok.count() == 2 and bad.count() == 1
    assert bad.collect()[0].errors == ["required field sha is null"]
    m = ING.load_metrics(df, "raw_commits").collect()[0]
    assert (m.total_rows, m.successful_rows, m.failed_rows, m.error_count) == (3, 2, 1, 1)
    m2 = ING.load_metrics(_commits(spark, [None, "b", None]), "raw_commits").collect()[0]
    assert (m2.total_rows, m2.successful_rows) == (3, 1)


def test_metrics_empty_input(spark):
    m = ING.load_metrics(_commits(spark, []), "raw_commits").collect()[0]
    assert (m.total_rows, m.successful_rows, m.error_count) == (0, 0, 0)


def test_multiple_errors_per_row_count_once_as_row(spark):
    df = spark.createDataFrame([(None, None)], "sha string, ingestion_timestamp timestamp_ntz")
    m = ING.load_metrics(df, "raw_commits").collect()[0]
    assert (m.total_rows, m.successful_rows, m.failed_rows, m.error_count) == (1, 0, 1, 2)


def test_malformed_language_body_fails(spark, workdir):
    write_page(workdir, "languages", None, repo="o/a", raw_text='{"Java": 1')
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        ING.to_raw_languages(L.read_languages_json(spark, workdir)).collect()
