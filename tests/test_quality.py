import datetime as dt

from repolens.operators import quality as Q

S = "k string, v string, t timestamp_ntz"


def _df(spark, rows):
    return spark.createDataFrame(rows, S)


def test_single_checks_ignore_nulls(spark):
    df = _df(spark, [("a", "x", None), ("a", "y", None), (None, None, None), (None, "z", None), ("b", "q", None)])
    assert [(r.k, r.n) for r in Q.check_unique(df, "k").collect()] == [("a", 2)]
    assert Q.check_not_null(df, "k").count() == 2
    bad = sorted((r.v, r.n) for r in Q.check_accepted(df, "v", ["x", "y"]).collect())
    assert bad == [("q", 1), ("z", 1)]
    parent = _df(spark, [("a", None, None)])
    assert sorted(r.k for r in Q.check_fk(df, "k", parent, "k").collect()) == ["b"]


def test_range_and_freshness(spark):
    nums = spark.createDataFrame([(0.5,), (1.5,), (None,), (-0.1,)], "p double")
    assert Q.check_range(nums, "p", 0, 1).count() == 2
    now = dt.datetime(2024, 1, 3, 0, 0)
    for t, status in ((dt.datetime(2024, 1, 2, 1), "pass"), (dt.datetime(2024, 1, 1, 23), "warn"),
                      (dt.datetime(2023, 12, 31, 23), "error")):
        r = Q.freshness(_df(spark, [("a", "b", t)]), "t", now).collect()[0]
        assert r.status == status, (t, r)
    assert Q.freshness(_df(spark, []), "t", now).collect()[0].status == "error"
    assert Q.check_recency(_df(spark, [("a", "b", dt.datetime(2024, 1, 1, 0))]), "t", now).collect()[0].status == "pass"


def test_suite_runner_statuses(spark):
    df = _df(spark, [("a", "x", dt.datetime(2024, 1, 1)), ("a", None, dt.datetime(2024, 1, 1))])
    parent = _df(spark, [("z", None, None)])
    suite = [Q.Check("unique", "m", "k"), Q.Check("not_null", "m", "v"),
             Q.Check("accepted_values", "m", "v", ("x",)), Q.Check("relationships", "m", "k", to="p", field="k"),
             Q.Check("range", "m", "k", lo="b"), Q.Check("freshness", "m", "t")]
    out = {r.check_name: (r.failures, r.status)
           for r in Q.run_checks(spark, {"m": df, "p": parent}, suite, now="2024-01-05 00:00:00").collect()}
    assert out["unique_m_k"] == (1, "fail")
    assert out["not_null_m_v"] == (1, "fail")
    assert out["accepted_values_m_v"] == (0, "pass")
    assert out["relationships_m_k__p_k"] == (2, "fail")
    assert out["range_m_k"] == (2, "fail")
    assert out["freshness_m_t"] == (1, "error")


def test_coverage_and_success_rate(spark):
    c = spark.createDataFrame([("commits", 95, 100), ("prs", 5, 10), ("x", 0, 0)],
                              "entity string, warehouse_rows bigint, source_rows bigint")
    out = {r.entity: (r.coverage, r.meets_target) for r in Q.coverage(c).collect()}
    assert out == {"commits": (0.95, True), "prs": (0.5, False), "x": (None, False)}
    runs = spark.createDataFrame([(dt.date(2024, 1, d), d != 3) for d in range(1, 31)] + [(dt.date(2023, 1, 1), False)],
                                 "run_date date, success boolean")
    r = Q.success_rate(runs, "2024-01-30").collect()[0]
    assert (r.runs, r.successful_runs, r.meets_target) == (30, 29, True)


def test_relationships_counted_without_a_join(spark):
    child = spark.createDataFrame([(1, 7), (1, None), (2, 8), (9, 9), (9, 9), (None, 7)], "a int, b bigint")
    parent = spark.createDataFrame([(1,), (2,), (2,), (None,), (8,)], "k bigint")
    suite = [Q.Check("relationships", "child", c, to="parent", field="k") for c in ("a", "b")]
    df = Q.run_checks(spark, {"child": child, "parent": parent}, suite)
    assert {r.column_name: (r.failures, r.status) for r in df.collect()} == {"a": (2, "fail"), "b": (4, "fail")}   # b: 7, 9, 9, 7
    assert "Join" not in df._jdf.queryExecution().optimizedPlan().toString()
    empty = Q.run_checks(spark, {"child": child.limit(0), "parent": parent.limit(0)}, suite)
    assert {(r.failures, r.status) for r in empty.collect()} == {(0, "pass")}
