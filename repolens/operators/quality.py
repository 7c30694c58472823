"""Declarative data-quality checks (DQ-01..10).

Each single check returns its *failing rows* (empty = pass); NULLs are
ignored by ``unique``, ``accepted_values`` and ``relationships`` as in
dbt.  ``run_checks`` evaluates a whole suite as one plan: all row-level
checks of a model (not_null, accepted_values, range) are folded into a
single aggregation with one ``count_if`` per check, so each model is
scanned once for them; ``unique`` and ``relationships`` are grouped
counts, each aggregated to one number.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import elapsed_seconds
from ..schemas import ENTITIES, LANDED_AT, ROW_KEYS


# ----------------------------------------------------------------- single checks
def check_unique(df: DataFrame, col: str) -> DataFrame:
    """DQ-01: values that occur more than once (NULL ignored)."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1))


def check_not_null(df: DataFrame, col: str) -> DataFrame:
    """DQ-02: rows where the column is NULL."""
    return df.filter(F.col(col).isNull())


def check_accepted(df: DataFrame, col: str, values) -> DataFrame:
    """DQ-03: each value outside the accepted list, with its row count."""
    return (df.filter(F.col(col).isNotNull() & ~F.col(col).isin(list(values)))
            .groupBy(col).agg(F.count(F.lit(1)).alias("n")))


def check_fk(child: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    """DQ-04: child rows whose non-NULL key has no parent (left anti join)."""
    p = parent.select(F.col(parent_col).alias("_fk")).filter(F.col("_fk").isNotNull())
    return child.filter(F.col(col).isNotNull()).join(p, F.col(col) == F.col("_fk"), "left_anti")


def check_range(df: DataFrame, col: str, lo=None, hi=None) -> DataFrame:
    """DQ-07: non-NULL values below ``lo`` or above ``hi`` (inclusive bounds)."""
    return df.filter(_out_of_range(F.col(col), lo, hi))


def _out_of_range(c: Column, lo, hi) -> Column:
    cond = F.lit(False)
    if lo is not None:
        cond = cond | (c < F.lit(lo))
    if hi is not None:
        cond = cond | (c > F.lit(hi))
    return c.isNotNull() & cond


def _ts_lit(now) -> Column:
    if isinstance(now, _dt.datetime):
        now = now.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(str(now)).cast("timestamp_ntz")


def freshness(df: DataFrame, col: str, now, warn_hours: int = 24, error_hours: int = 48) -> DataFrame:
    """DQ-05: age of the newest row; status pass / warn / error.  A table
    without rows is an error."""
    m = df.agg(F.max(col).alias("max_loaded_at"))
    age_s = elapsed_seconds(F.col("max_loaded_at"), _ts_lit(now))
    return m.select(
        "max_loaded_at",
        (age_s.cast("double") / 3600.0).alias("age_hours"),
        F.when(F.col("max_loaded_at").isNull() | (age_s > error_hours * 3600), "error")
         .when(age_s > warn_hours * 3600, "warn").otherwise("pass").alias("status"))


def check_recency(df: DataFrame, col: str, now, hours: int = 48) -> DataFrame:
    """DQ-06: the newest value must be within ``hours`` of ``now``."""
    m = df.agg(F.max(col).alias("max_value"))
    age_s = elapsed_seconds(F.col("max_value"), _ts_lit(now))
    return m.select("max_value", (age_s.cast("double") / 3600.0).alias("age_hours"),
                    F.when(F.col("max_value").isNotNull() & (age_s <= hours * 3600), "pass")
                     .otherwise("fail").alias("status"))


def coverage(counts: DataFrame, target: float = 0.9) -> DataFrame:
    """DQ-09: from (entity, warehouse_rows, source_rows): ratio and whether
    it exceeds the target."""
    ratio = F.try_divide(F.col("warehouse_rows").cast("double"), F.col("source_rows").cast("double"))
    return counts.select("entity", "warehouse_rows", "source_rows", ratio.alias("coverage"),
                         F.coalesce(ratio > F.lit(target), F.lit(False)).alias("meets_target"))


def landed_coverage(ledgers: dict[str, DataFrame], raw: dict[str, DataFrame], target: float = 0.9) -> DataFrame:
    """DQ-09 against what landed: per (entity, repository) the objects of its
    landed files, as the ledger counted them, the rows of them that the raw
    tables hold (a row that a full run loaded again counts once), their ratio
    and whether it exceeds the target.  Repository pages belong to no single
    repository: their row has none."""
    parts = []
    for entity, ledger in ledgers.items():
        repo = F.lit(None).cast("string") if entity == "repositories" else F.col("repo_full_name")
        table = ENTITIES[entity]
        rows = raw[entity].withColumn("repo_full_name", repo).dropDuplicates(["repo_full_name", *ROW_KEYS[table], LANDED_AT])
        both = (ledger.select(F.col("repoFullName").alias("repo_full_name"), F.col("records").alias("landed"), F.lit(0).alias("loaded"))
                .unionByName(rows.select("repo_full_name", F.lit(0).alias("landed"), F.lit(1).alias("loaded"))))
        parts.append(both.groupBy("repo_full_name").agg(F.sum("landed").alias("landed"), F.sum("loaded").alias("loaded"))
                     .select(F.lit(entity).alias("entity"), "*"))
    ratio = F.try_divide(F.col("loaded").cast("double"), F.col("landed").cast("double"))
    return (reduce(DataFrame.unionByName, parts).withColumn("ratio", ratio)
            .withColumn("meets_target", F.coalesce(F.col("ratio") > F.lit(target), F.lit(False))))


def success_rate(runs: DataFrame, as_of, days: int = 30, target: float = 0.95,
                 date_col: str = "run_date") -> DataFrame:
    """DQ-10: share of successful runs in the ``days`` days ending on ``as_of``."""
    end = F.lit(str(as_of)).cast("date")
    w = runs.filter((F.col(date_col) > F.date_sub(end, days)) & (F.col(date_col) <= end))
    rate = F.try_divide(F.count_if("success").cast("double"), F.count(F.lit(1)).cast("double"))
    return w.agg(F.count(F.lit(1)).alias("runs"), F.count_if("success").alias("successful_runs"),
                 rate.alias("success_rate"),
                 F.coalesce(rate > F.lit(target), F.lit(False)).alias("meets_target"))


# ----------------------------------------------------------------- suite
@dataclass(frozen=True)
class Check:
    kind: str                  # unique | not_null | accepted_values | relationships | range | freshness | recency
    model: str
    column: str
    values: tuple = ()
    to: str | None = None      # relationships: parent model
    field: str | None = None   # relationships: parent column
    lo: float | None = None
    hi: float | None = None
    warn_hours: int = 24
    error_hours: int = 48

    @property
    def name(self) -> str:
        base = f"{self.kind}_{self.model}_{self.column}"
        return f"{base}__{self.to}_{self.field}" if self.kind == "relationships" else base


_ROW_LEVEL = ("not_null", "accepted_values", "range")
_AGE_LEVEL = ("freshness", "recency")


_OUT = "check_name string, kind string, model string, column_name string, failures bigint, status string"
_COLS = [c.split()[0] for c in _OUT.split(", ")]


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _sql_lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(v)


def _sql_failure(ch: Check) -> str:
    c = _q(ch.column)
    if ch.kind == "not_null":
        return f"{c} IS NULL"
    if ch.kind == "accepted_values":
        return f"{c} IS NOT NULL AND {c} NOT IN ({', '.join(_sql_lit(v) for v in ch.values)})"
    ors = ([f"{c} < {_sql_lit(ch.lo)}"] if ch.lo is not None else []) + \
          ([f"{c} > {_sql_lit(ch.hi)}"] if ch.hi is not None else [])
    return f"{c} IS NOT NULL AND ({' OR '.join(ors) or 'false'})"


def _sql_age_status(ch: Check, mx: str, now) -> str:
    if isinstance(now, _dt.datetime):
        now = now.strftime("%Y-%m-%d %H:%M:%S.%f")
    age = f"CAST(CAST(CAST({_sql_lit(str(now))} AS TIMESTAMP_NTZ) - {mx} AS INTERVAL SECOND) AS BIGINT)"
    if ch.kind == "freshness":
        return (f"CASE WHEN {mx} IS NULL OR {age} > {ch.error_hours * 3600} THEN 'error' "
                f"WHEN {age} > {ch.warn_hours * 3600} THEN 'warn' ELSE 'pass' END")
    return f"CASE WHEN {mx} IS NOT NULL AND {age} <= {ch.error_hours * 3600} THEN 'pass' ELSE 'fail' END"


def _sql_row(ch: Check, failures: str, status: str | None = None) -> str:
    status = status or f"CASE WHEN {failures} = 0 THEN 'pass' ELSE 'fail' END"
    return (f"named_struct('check_name', {_sql_lit(ch.name)}, 'kind', {_sql_lit(ch.kind)}, "
            f"'model', {_sql_lit(ch.model)}, 'column_name', {_sql_lit(ch.column)}, "
            f"'failures', CAST({failures} AS BIGINT), 'status', {status})")


def _model_scalars(df: DataFrame, checks: list[Check], now) -> DataFrame:
    """All row-level and age checks of one model in one aggregation (one
    scan), unpivoted to one row per check.  Checks are generated as SQL
    expressions, one JVM call each."""
    aggs = [(f"count_if({_sql_failure(ch)})" if ch.kind in _ROW_LEVEL else f"max({_q(ch.column)})") + f" AS c{i}"
            for i, ch in enumerate(checks)]
    rows = []
    for i, ch in enumerate(checks):
        if ch.kind in _ROW_LEVEL:
            rows.append(_sql_row(ch, f"c{i}"))
        else:
            st = _sql_age_status(ch, f"c{i}", now)
            rows.append(_sql_row(ch, f"CASE WHEN {st} = 'pass' THEN 0 ELSE 1 END", st))
    return df.selectExpr(*aggs).selectExpr(f"inline(array({', '.join(rows)}))")


def _all_unique(spark: SparkSession, models: dict[str, DataFrame], unique: dict[str, list[Check]]) -> DataFrame:
    """Every unique check of the suite with one shuffle: each model emits
    (check id, value as text) pairs, all pairs are counted together, then
    repeated values are counted per check; checks without repeats get 0."""
    checks: list[Check] = []
    parts = []
    for m, cs in unique.items():
        pairs = []
        for ch in cs:
            pairs.append(f"named_struct('i', {len(checks)}, 'v', CAST({_q(ch.column)} AS STRING))")
            checks.append(ch)
        parts.append(models[m].selectExpr(f"inline(array({', '.join(pairs)}))"))
    dup = (_union_all(parts).filter("v IS NOT NULL").groupBy("i", "v").agg(F.count(F.lit(1)).alias("n"))
           .filter("n > 1").selectExpr("i", "CAST(1 AS BIGINT) AS failures"))
    return _per_check(spark, dup, checks)


def _fk_group(models: dict[str, DataFrame], parent: str, field: str, checks: list[Check]) -> DataFrame:
    """All relationships checks against one parent key with one shuffle and
    no join: children emit (check id, key), the parent (-1, key); counts per
    key combine before the shuffle, so a common key is one row a task.  The
    counts of keys that the parent lacks add up to the failures."""
    by_model: dict[str, list[str]] = {parent: [f"named_struct('i', -1, 'k', {_q(field)})"]}
    for i, ch in enumerate(checks):
        by_model.setdefault(ch.model, []).append(f"named_struct('i', {i}, 'k', {_q(ch.column)})")
    keys = _union_all([models[m].selectExpr(f"inline(array({', '.join(pairs)}))") for m, pairs in by_model.items()])
    n = range(len(checks))
    per_key = (keys.filter("k IS NOT NULL").groupBy("k")
               .agg(F.expr("bool_or(i = -1)").alias("known"), *[F.expr(f"count_if(i = {i})").alias(f"c{i}") for i in n]))
    sums = per_key.filter("NOT known").agg(*[F.coalesce(F.sum(f"c{i}"), F.lit(0)).alias(f"c{i}") for i in n])
    return sums.selectExpr(f"inline(array({', '.join(_sql_row(ch, f'c{i}') for i, ch in enumerate(checks))}))")


def _per_check(spark: SparkSession, failing: DataFrame, checks: list[Check]) -> DataFrame:
    """Sum failing rows (i, 1) per check id, with a zero row for every check
    so passing checks appear too (an aggregate, not a join), and turn each
    id into its result row."""
    zeros = spark.range(len(checks)).selectExpr("CAST(id AS INT) AS i", "CAST(0 AS BIGINT) AS failures")
    tot = failing.selectExpr("CAST(i AS INT) AS i", "failures").unionByName(zeros) \
        .groupBy("i").agg(F.sum("failures").alias("failures"))
    rows = ", ".join(_sql_row(ch, "failures") for ch in checks)
    return tot.selectExpr(f"element_at(array({rows}), i + 1) AS r").select("r.*")


def _union_all(parts: list[DataFrame]) -> DataFrame:
    """Balanced union (keeps analysis linear in the number of parts)."""
    while len(parts) > 1:
        parts = [parts[k].unionByName(parts[k + 1]) if k + 1 < len(parts) else parts[k]
                 for k in range(0, len(parts), 2)]
    return parts[0]


def run_checks(spark: SparkSession, models: dict[str, DataFrame], suite: list[Check], now=None) -> DataFrame:
    """DQ-08: evaluate a suite to one table (check_name, kind, model,
    column_name, failures, status).  Per model: one aggregation for all
    row-level and age checks, one grouped count for all unique checks and
    one per parent for relationships.  Nothing is collected: the
    result is one plan computed by a single action."""
    scalar: dict[str, list[Check]] = {}
    unique: dict[str, list[Check]] = {}
    for ch in suite:
        if ch.kind in _ROW_LEVEL or ch.kind in _AGE_LEVEL:
            scalar.setdefault(ch.model, []).append(ch)
        elif ch.kind == "unique":
            unique.setdefault(ch.model, []).append(ch)
    parts = [_model_scalars(models[m], cs, now) for m, cs in scalar.items()]
    if unique:
        parts.append(_all_unique(spark, models, unique))
    by_parent: dict[tuple[str, str], list[Check]] = {}
    for ch in suite:
        if ch.kind == "relationships":
            by_parent.setdefault((ch.to, ch.field), []).append(ch)
    for (parent, field), cs in by_parent.items():
        parts.append(_fk_group(models, parent, field, cs))
    if not parts:
        return spark.createDataFrame([], _OUT)
    return _union_all([p.select(*_COLS) for p in parts])


# The reference's declared model tests (82) and source freshness rules (5).
_STATES_PR = ("open", "closed", "merged")
_STATES_REVIEW = ("APPROVED", "CHANGES_REQUESTED", "COMMENTED", "DISMISSED")
_VISIBILITY = ("public", "private")


def _nn(model, *cols):
    return [Check("not_null", model, c) for c in cols]


def _uq(model, *cols):
    return [Check("unique", model, c) for c in cols]


REFERENCE_SUITE: list[Check] = [
    # staging
    *_uq("stg_commits", "commit_sha"), *_nn("stg_commits", "commit_sha", "repo_full_name", "authored_at"),
    *_uq("stg_pull_requests", "pr_id"),
    *_nn("stg_pull_requests", "pr_id", "pr_number", "repo_full_name", "state", "created_at", "is_merged"),
    Check("accepted_values", "stg_pull_requests", "state", _STATES_PR),
    *_uq("stg_reviews", "review_id"),
    *_nn("stg_reviews", "review_id", "repo_full_name", "pr_number", "pr_id", "review_state", "submitted_at"),
    Check("accepted_values", "stg_reviews", "review_state", _STATES_REVIEW),
    *_uq("stg_repositories", "repository_id", "full_name"),
    *_nn("stg_repositories", "repository_id", "repository_name", "full_name", "owner", "is_fork"),
    Check("accepted_values", "stg_repositories", "visibility", _VISIBILITY),
    *_nn("stg_languages", "repo_full_name", "language_name", "byte_count"),
    # mart
    *_uq("dim_date", "date_key", "full_date"),
    *_nn("dim_date", "date_key", "full_date", "day_of_week", "day_name", "day_of_month", "iso_week_number",
         "month_number", "month_name", "quarter", "year", "is_weekend"),
    Check("accepted_values", "dim_date", "day_of_week", (1, 2, 3, 4, 5, 6, 7)),
    Check("accepted_values", "dim_date", "month_number", (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12)),
    Check("accepted_values", "dim_date", "quarter", (1, 2, 3, 4)),
    *_uq("dim_repository", "repo_id", "repo_full_name"),
    *_nn("dim_repository", "repo_id", "repo_name", "repo_full_name", "owner", "is_fork"),
    Check("accepted_values", "dim_repository", "visibility", _VISIBILITY),
    *_uq("fct_commits", "commit_sha"), *_nn("fct_commits", "commit_sha", "repo_id", "committed_at"),
    Check("relationships", "fct_commits", "repo_id", to="dim_repository", field="repo_id"),
    Check("relationships", "fct_commits", "date_key", to="dim_date", field="date_key"),
    *_uq("fct_pull_requests", "pr_key"),
    *_nn("fct_pull_requests", "pr_key", "repo_id", "pr_number", "state", "is_merged", "created_at"),
    Check("accepted_values", "fct_pull_requests", "state", _STATES_PR),
    Check("relationships", "fct_pull_requests", "repo_id", to="dim_repository", field="repo_id"),
    Check("relationships", "fct_pull_requests", "created_date_key", to="dim_date", field="date_key"),
    Check("relationships", "fct_pull_requests", "merged_date_key", to="dim_date", field="date_key"),
    *_uq("fct_reviews", "review_id"),
    *_nn("fct_reviews", "review_id", "repo_id", "pr_key", "review_state", "submitted_at"),
    Check("accepted_values", "fct_reviews", "review_state", _STATES_REVIEW),
    Check("relationships", "fct_reviews", "repo_id", to="dim_repository", field="repo_id"),
    Check("relationships", "fct_reviews", "pr_key", to="fct_pull_requests", field="pr_key"),
    Check("relationships", "fct_reviews", "date_key", to="dim_date", field="date_key"),
]

SOURCE_FRESHNESS: list[Check] = [
    Check("freshness", t, "ingestion_timestamp", warn_hours=24, error_hours=48)
    for t in ("raw_commits", "raw_pull_requests", "raw_reviews", "raw_repositories", "raw_languages")
]

# Specified (not coded) in the reference: recency of commits, value ranges.
SPECIFIED_SUITE: list[Check] = [
    Check("recency", "fct_commits", "committed_at", error_hours=48),
    Check("range", "stg_languages", "language_percentage", lo=0, hi=1),
    Check("range", "fct_commits", "hour_of_day", lo=0, hi=23),
    Check("range", "fct_pull_requests", "time_to_merge_hours", lo=0),
]
