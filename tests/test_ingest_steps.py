"""Steps of an ingest run: one failed (repository, entity) alone, files read
once, scope by the repository list, landing instants, many PRs in a file."""

import datetime as dt
import os

from repolens.operators import incremental as INC
from repolens.operators import quality as Q
from repolens.operators import sinks
from repolens.plans import refresh, staging
from repolens.sources import landing as L
from tests.jsonland import commit, pull, repository, review, write_page

DAY = dt.datetime(2024, 5, 12, 2)


def run(spark, landing, root, day=0, **more):
    log = refresh.run_ingest(spark, landing, root, run_instant=DAY + dt.timedelta(days=day), **more).collect()
    return {(r.entityType, r.repoFullName): r for r in log}, log


def two_repos(landing):
    write_page(landing, "repositories", [repository(1, "user/repo1"), repository(2, "user/repo2", "Python")])
    for k in (1, 2):
        repo = f"user/repo{k}"
        write_page(landing, "commits", [commit(f"sha{k}")], repo=repo)
        write_page(landing, "pull_requests", [pull(k)], repo=repo)
        write_page(landing, "reviews", [{"pr_number": k, "reviews": [review(10 + k), review(20 + k)]},
                                        {"pr_number": 99, "reviews": [review(90 + k)]}, {"pr_number": 5, "reviews": []}], repo=repo)
        write_page(landing, "languages", None, repo=repo, raw_text='{"Java": 1000}')


def shas(spark, root):
    return sorted(r.sha for r in sinks.read_raw(spark, root, "raw_commits").collect())


def test_commits_fail_for_one_repository_only(spark, workdir):
    """Mixed success: a malformed page of repo1 leaves repo2's commits loaded."""
    landing, root = f"{workdir}/l", f"{workdir}/wh"
    two_repos(landing)
    bad = write_page(landing, "commits", None, repo="user/repo1", page=2, raw_text='[{"sha": "x"}, {"sha": ')
    res, log = run(spark, landing, root)
    row = res[("commits", "user/repo1")]
    assert not row.success and bad.rsplit("/", 1)[1] in row.errorMessage and "user%2Frepo1" in row.errorMessage
    assert res[("commits", "user/repo2")].success and res[("commits", "user/repo2")].recordsLoaded == 1
    assert shas(spark, root) == ["sha2"] and sum(not r.success for r in log) == 1
    assert INC.get_watermark(spark, root, "commits") is None
    assert INC.get_watermark(spark, root, "pull_requests") == DAY
    # mended: the step's files are all loaded in the next run, the other repository's are not read again
    write_page(landing, "commits", [commit("x")], repo="user/repo1", page=2)
    res, log = run(spark, landing, root, 1)
    assert all(r.success for r in log) and shas(spark, root) == ["sha1", "sha2", "x"]
    assert res[("commits", "user/repo1")].recordsLoaded == 2 and res[("commits", "user/repo2")].recordsLoaded == 0
    assert INC.get_watermark(spark, root, "commits") == DAY + dt.timedelta(days=1)


def test_a_pull_request_failure_goes_on_and_is_reported(spark, workdir):
    landing, root = f"{workdir}/l", f"{workdir}/wh"
    two_repos(landing)
    page = write_page(landing, "pull_requests", None, repo="user/repo1", raw_text='{"message": "rate limit"')
    res, log = run(spark, landing, root)
    assert [(r.entityType, r.repoFullName) for r in log if not r.success and r.entityType == "pull_requests"] == [
        ("pull_requests", "user/repo1")]
    assert not res[("reviews", "user/repo1")].success and res[("reviews", "user/repo2")].recordsLoaded == 2
    assert res[("languages", "user/repo1")].success and res[("commits", "user/repo1")].success
    assert INC.get_watermark(spark, root, "pull_requests") is None and INC.get_watermark(spark, root, "reviews") is None
    assert INC.get_watermark(spark, root, "languages") == DAY
    os.remove(page)
    write_page(landing, "pull_requests", [pull(1)], repo="user/repo1", page=2)
    res, log = run(spark, landing, root, 1)
    assert all(r.success for r in log) and res[("reviews", "user/repo1")].recordsLoaded == 2
    # reported as success instead; the files wait
    root2 = f"{workdir}/wh2"
    write_page(landing, "pull_requests", None, repo="user/repo1", raw_text="[")
    res, _ = run(spark, landing, root2, reviews_need_prs=False)
    assert res[("reviews", "user/repo1")].success and res[("reviews", "user/repo1")].recordsLoaded == 0
    os.remove(page)
    res, _ = run(spark, landing, root2, 1)
    assert res[("reviews", "user/repo1")].recordsLoaded == 2


def test_an_empty_list_or_a_failed_one_extracts_nothing(spark, workdir):
    landing, root = f"{workdir}/l", f"{workdir}/wh"
    two_repos(landing)
    write_page(landing, "repositories", [])
    _, log = run(spark, landing, root)
    assert [(r.entityType, r.success) for r in log] == [("repositories", True)] and shas(spark, root) == []
    write_page(landing, "repositories", None, page=2, raw_text="[{")
    _, log = run(spark, landing, f"{workdir}/wh2")
    assert [(r.entityType, r.success) for r in log] == [("repositories", False)]


def test_unlisted_repositories_are_not_read(spark, workdir, monkeypatch):
    landing, root = f"{workdir}/l", f"{workdir}/wh"
    two_repos(landing)
    write_page(landing, "repositories", [repository(2, "user/repo2")])
    write_page(landing, "commits", None, repo="user/repo1", raw_text="[ malformed")     # would fail if it were read
    read = []
    plain = L.read_files
    monkeypatch.setattr(L, "read_files", lambda spark, e, files: (read.extend(files), plain(spark, e, files))[1])
    res, log = run(spark, landing, root)
    assert all(r.success for r in log) and {r.repoFullName for r in log} == {"user/repo2"}
    assert read and not any("repo1" in f for f in read)
    # no new list: the newest one holds
    write_page(landing, "commits", [commit("later", date="2024-06-01T00:00:00Z")], repo="user/repo2", page=2)
    run(spark, landing, root, 1)
    assert shas(spark, root) == ["later", "sha2"]


def test_second_run_reads_no_old_page(spark, workdir, monkeypatch):
    landing, root = f"{workdir}/l", f"{workdir}/wh"
    two_repos(landing)
    run(spark, landing, root)
    read = []
    plain = L.read_files
    monkeypatch.setattr(L, "read_files", lambda spark, e, files: (read.extend(files), plain(spark, e, files))[1])
    _, log = run(spark, landing, root, 1)
    assert read == [] and all(r.success for r in log)
    new = write_page(landing, "commits", [commit("new", date="2024-06-01T00:00:00Z")], repo="user/repo1", page=2)
    run(spark, landing, root, 2)
    assert [f.replace("file:", "") for f in read] == [new] and shas(spark, root) == ["new", "sha1", "sha2"]
    read.clear()
    run(spark, landing, root, 3, full=True)
    assert len(read) == 10
    # every file of the landing folder is in the ledger, with its counts
    ledger = refresh.read_ledger(spark, root, "reviews").collect()
    assert sorted((r.repoFullName, r.records, r.kept, r.waits) for r in ledger) == [
        ("user/repo1", 3, 2, [99]), ("user/repo2", 3, 2, [99])]


def test_reviews_wait_for_their_pull_request(spark, workdir):
    landing, root = f"{workdir}/l", f"{workdir}/wh"
    two_repos(landing)
    run(spark, landing, root)
    write_page(landing, "pull_requests", [pull(99, updated="2024-06-20T00:00:00Z")], repo="user/repo1", page=2)
    res, _ = run(spark, landing, root, 1)
    assert res[("reviews", "user/repo1")].recordsLoaded == 1
    got = sorted((r.id, r.pr_number) for r in staging.stg_reviews(sinks.read_raw(spark, root, "raw_reviews")).withColumnRenamed(
        "review_id", "id").collect())
    assert got == [(11, 1), (12, 2), (21, 1), (22, 2), (91, 99)]


def test_both_review_layouts_and_the_listing(spark, workdir):
    landing = f"{workdir}/l"
    two_repos(landing)
    write_page(landing, "reviews", [review(70, body="x")], repo="user/repo1", pr=7)
    write_page(landing, "reviews", [], repo="user/repo1", pr=8)
    rows = L.read_reviews_json(spark, landing).collect()
    assert sorted((r.repo_full_name, r.pr_number, r.id) for r in rows) == [
        ("user/repo1", 1, 11), ("user/repo1", 1, 21), ("user/repo1", 7, 70), ("user/repo1", 99, 91),
        ("user/repo2", 2, 12), ("user/repo2", 2, 22), ("user/repo2", 99, 92)]
    many = f"{workdir}/many"
    write_page(many, "reviews", [{"pr_number": n, "reviews": [review(n)]} for n in range(500)], repo="o/with space+plus")
    files = L.landed_files(spark, many, "reviews").collect()
    assert [r.repoFullName for r in files] == ["o/with space+plus"]        # one file, whatever the pull requests
    assert L.read_reviews_json(spark, many).count() == 500


def test_of_two_snapshots_in_one_batch_the_later_landed_wins(spark, workdir):
    landing, root = f"{workdir}/l", f"{workdir}/wh"
    two_repos(landing)
    for repo, sizes in (("user/repo1", (1000, 400)), ("user/repo2", (400, 1000))):
        for page, (size, at) in enumerate(zip(sizes, (1_700_000_000, 1_700_000_060)), 1):
            p = write_page(landing, "languages", None, repo=repo, page=page, raw_text=f'{{"Java": {size}}}')
            os.utime(p, (at, at))
    run(spark, landing, root)
    raw = sinks.read_raw(spark, root, "raw_languages")
    got = {r.repo_full_name: r.byte_count for r in staging.stg_languages(raw).collect()}
    assert got == {"user/repo1": 400, "user/repo2": 1000}
    assert raw.agg({"landed_at": "max"}).first()[0] == dt.datetime(2023, 11, 14, 22, 14, 20)


def test_coverage_falls_with_a_dropped_page(spark, workdir):
    landing, root = f"{workdir}/l", f"{workdir}/wh"
    two_repos(landing)
    write_page(landing, "commits", [commit("more1"), commit("more2"), commit("more3")], repo="user/repo1", page=2)
    run(spark, landing, root)

    def ratios():
        return {(r.entity, r.repo_full_name): (r.landed, r.loaded, r.ratio) for r in Q.landed_coverage(
            {e: refresh.read_ledger(spark, root, e) for e in refresh.ORDER},
            {e: sinks.read_raw(spark, root, t) for e, t in refresh.ENTITIES.items()}).collect()}

    before = ratios()
    assert before[("commits", "user/repo1")] == (4, 4, 1.0) and before[("reviews", "user/repo2")] == (3, 2, 2 / 3)
    # the rows of one page are lost from the warehouse
    kept = sinks.read_raw(spark, root, "raw_commits").filter("sha NOT LIKE 'more%'").drop("ingestion_date").checkpoint()
    sinks.delete(spark, f"{root}/raw/raw_commits")
    sinks.append_raw(kept, root, "raw_commits")
    assert ratios()[("commits", "user/repo1")] == (4, 1, 0.25)
    assert ratios()[("commits", "user/repo2")] == (1, 1, 1.0)


def test_all_six_tables_are_created(spark, workdir):
    made = sinks.ensure_tables(spark, workdir)
    assert len(made) == 6 and all(sinks.exists(spark, f"{workdir}/raw/{t}") for t in made)
    assert INC.read_watermarks(spark, workdir).count() == 0
    assert sinks.ensure_tables(spark, workdir) == []
    INC.set_watermark(spark, workdir, "commits", DAY)
    assert INC.get_watermark(spark, workdir, "commits") == DAY
