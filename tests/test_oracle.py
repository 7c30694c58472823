"""Every registered query against its DuckDB oracle on the smallest scale
(the driver runs the same comparison at sf0.01)."""

import pytest

import __spark_entry__ as E
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, con, name):
    qs = E.queries()
    if name not in ORACLE:
        assert qs[name](spark, SF).count() >= 0
        return
    ok, detail = compare(spark, con, name, qs[name], ORACLE[name], SF)
    assert ok, detail


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"repo_full_name", "merge_rate", "is_total"} <= set(df.columns)


ZONE_SENSITIVE = ("stg_pull_requests", "stg_commits", "dsh_review_turnaround", "agg_weekly_activity",
                  "dsh_activity_timeline", "dq_freshness", "dq_suite", "dsh_streaks")


@pytest.mark.parametrize("name", ZONE_SENSITIVE)
def test_results_do_not_depend_on_session_time_zone(spark, con, name):
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "America/New_York")
    ok, detail = compare(other, con, name, E.queries()[name], ORACLE[name], SF)
    assert ok, detail
