"""Registered data-quality queries (DQ-01..09) with oracle SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .catalog import O, register
from .operators import quality as Q
from .queries_ops import CHECK_NOW
from .schemas import ENTITIES, LANDED_AT, ROW_KEYS

MODELS = ("raw_commits", "raw_pull_requests", "raw_reviews", "raw_repositories", "raw_languages",
          "stg_commits", "stg_pull_requests", "stg_reviews", "stg_repositories", "stg_languages",
          "dim_date", "dim_repository", "fct_commits", "fct_pull_requests", "fct_reviews")

SUITE = Q.REFERENCE_SUITE + Q.SOURCE_FRESHNESS + Q.SPECIFIED_SUITE


def _models(w) -> dict[str, DataFrame]:
    w.ensure(*MODELS)       # at once, so independent tables are written side by side
    return {m: getattr(w, m) for m in MODELS}


def _lit(v) -> str:
    return f"'{v}'" if isinstance(v, str) else str(v)


def _check_sql(ch: Q.Check) -> str:
    meta = f"'{ch.name}' AS check_name, '{ch.kind}' AS kind, '{ch.model}' AS model, '{ch.column}' AS column_name"
    c = ch.column
    if ch.kind in ("freshness", "recency"):
        age = f"date_sub('second', max({c}), TIMESTAMP '{CHECK_NOW}')"
        if ch.kind == "freshness":
            st = (f"CASE WHEN max({c}) IS NULL OR {age} > {ch.error_hours * 3600} THEN 'error' "
                  f"WHEN {age} > {ch.warn_hours * 3600} THEN 'warn' ELSE 'pass' END")
        else:
            st = f"CASE WHEN max({c}) IS NOT NULL AND {age} <= {ch.error_hours * 3600} THEN 'pass' ELSE 'fail' END"
        return (f"SELECT {meta}, CAST(CASE WHEN {st} = 'pass' THEN 0 ELSE 1 END AS BIGINT) AS failures, "
                f"{st} AS status FROM {ch.model}")
    if ch.kind == "unique":
        f = (f"(SELECT count(*) FROM (SELECT {c} FROM {ch.model} WHERE {c} IS NOT NULL "
             f"GROUP BY {c} HAVING count(*) > 1))")
        return f"SELECT {meta}, {f} AS failures"
    if ch.kind == "relationships":
        f = (f"(SELECT count(*) FROM {ch.model} c WHERE c.{c} IS NOT NULL AND NOT EXISTS "
             f"(SELECT 1 FROM {ch.to} p WHERE p.{ch.field} = c.{c}))")
        return f"SELECT {meta}, {f} AS failures"
    if ch.kind == "not_null":
        cond = f"{c} IS NULL"
    elif ch.kind == "accepted_values":
        cond = f"{c} IS NOT NULL AND {c} NOT IN ({', '.join(_lit(v) for v in ch.values)})"
    else:
        ors = ([f"{c} < {ch.lo}"] if ch.lo is not None else []) + ([f"{c} > {ch.hi}"] if ch.hi is not None else [])
        cond = f"{c} IS NOT NULL AND ({' OR '.join(ors)})"
    return f"SELECT {meta}, count(*) FILTER (WHERE {cond}) AS failures FROM {ch.model}"


def suite_sql(checks) -> str:
    parts = []
    for ch in checks:
        q = _check_sql(ch)
        if ch.kind not in ("freshness", "recency"):
            q = f"SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM ({q})"
        parts.append(q)
    deps = sorted({ch.model for ch in checks} | {ch.to for ch in checks if ch.to})
    return O.sql("\nUNION ALL\n".join(parts), *deps)


@register("dq_suite", suite_sql(SUITE))
def dq_suite(w):
    """DQ-08: the reference's 82 model tests, 5 source freshness rules and
    the specified recency and range checks, as one result table."""
    return Q.run_checks(w.spark, _models(w), SUITE, now=CHECK_NOW)


@register("dq_unique_raw_keys", O.sql("""
SELECT 'raw_commits' AS model, CAST(sha AS VARCHAR) AS value, count(*) AS n FROM raw_commits
WHERE sha IS NOT NULL GROUP BY sha HAVING count(*) > 1
UNION ALL
SELECT 'raw_reviews', CAST(id AS VARCHAR), count(*) FROM raw_reviews
WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1""", "raw_commits", "raw_reviews"))
def dq_unique_raw_keys(w):
    """DQ-01 on raw keys: the repeated snapshots that staging removes."""
    a = Q.check_unique(w.raw_commits, "sha").select(F.lit("raw_commits").alias("model"),
                                                    F.col("sha").cast("string").alias("value"), "n")
    b = Q.check_unique(w.raw_reviews, "id").select(F.lit("raw_reviews").alias("model"),
                                                   F.col("id").cast("string").alias("value"), "n")
    return a.unionByName(b)


@register("dq_not_null_rows", O.sql("""
SELECT commit_sha, 'additions' AS column_name FROM fct_commits WHERE additions IS NULL
UNION ALL SELECT commit_sha, 'deletions' FROM fct_commits WHERE deletions IS NULL""", "fct_commits"))
def dq_not_null_rows(w):
    """DQ-02 failing rows on two nullable measure columns of the commit fact."""
    f = w.fct_commits
    return (Q.check_not_null(f, "additions").select("commit_sha", F.lit("additions").alias("column_name"))
            .unionByName(Q.check_not_null(f, "deletions").select("commit_sha", F.lit("deletions").alias("column_name"))))


@register("dq_accepted_raw_states", O.sql("""
SELECT 'raw_reviews' AS model, state AS value, count(*) AS n FROM raw_reviews
WHERE state IS NOT NULL AND state NOT IN ('APPROVED', 'CHANGES_REQUESTED', 'COMMENTED', 'DISMISSED') GROUP BY state
UNION ALL
SELECT 'raw_pull_requests', state, count(*) FROM raw_pull_requests
WHERE state IS NOT NULL AND state NOT IN ('open', 'closed', 'merged') GROUP BY state""",
    "raw_reviews", "raw_pull_requests"))
def dq_accepted_raw_states(w):
    """DQ-03 on raw states: the spellings that staging normalises."""
    a = Q.check_accepted(w.raw_reviews, "state", Q._STATES_REVIEW)
    b = Q.check_accepted(w.raw_pull_requests, "state", Q._STATES_PR)
    return (a.select(F.lit("raw_reviews").alias("model"), F.col("state").alias("value"), "n")
            .unionByName(b.select(F.lit("raw_pull_requests").alias("model"), F.col("state").alias("value"), "n")))


@register("dq_fk_orphans", O.sql("""
SELECT 'raw_reviews' AS child, CAST(r.id AS VARCHAR) AS child_key FROM raw_reviews r
WHERE r.repo_full_name IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM dim_repository d WHERE d.repo_full_name = r.repo_full_name)
UNION ALL
SELECT 'fct_reviews', CAST(f.review_id AS VARCHAR) FROM fct_reviews f
WHERE f.pr_key IS NOT NULL AND NOT EXISTS (SELECT 1 FROM fct_pull_requests p WHERE p.pr_key = f.pr_key)""",
    "raw_reviews", "dim_repository", "fct_reviews", "fct_pull_requests"))
def dq_fk_orphans(w):
    """DQ-04 failing rows: reviews whose repository or PR is unknown."""
    a = Q.check_fk(w.raw_reviews, "repo_full_name", w.dim_repository, "repo_full_name")
    b = Q.check_fk(w.fct_reviews, "pr_key", w.fct_pull_requests, "pr_key")
    return (a.select(F.lit("raw_reviews").alias("child"), F.col("id").cast("string").alias("child_key"))
            .unionByName(b.select(F.lit("fct_reviews").alias("child"),
                                  F.col("review_id").cast("string").alias("child_key"))))


_RAW = ("raw_commits", "raw_pull_requests", "raw_reviews", "raw_repositories", "raw_languages")


@register("dq_freshness", O.sql("\nUNION ALL\n".join(f"""
SELECT '{t}' AS source, max(ingestion_timestamp) AS max_loaded_at,
       CAST(date_sub('second', max(ingestion_timestamp), TIMESTAMP '{CHECK_NOW}') AS DOUBLE) / 3600.0 AS age_hours,
       CASE WHEN max(ingestion_timestamp) IS NULL
              OR date_sub('second', max(ingestion_timestamp), TIMESTAMP '{CHECK_NOW}') > 172800 THEN 'error'
            WHEN date_sub('second', max(ingestion_timestamp), TIMESTAMP '{CHECK_NOW}') > 86400 THEN 'warn'
            ELSE 'pass' END AS status
FROM {t}""" for t in _RAW), *_RAW))
def dq_freshness(w):
    """DQ-05 for the five raw sources (warn after 24 h, error after 48 h)."""
    parts = [Q.freshness(w.raw(t), "ingestion_timestamp", CHECK_NOW).select(F.lit(t).alias("source"), "*")
             for t in _RAW]
    return reduce(DataFrame.unionByName, parts)


@register("dq_recency", O.sql(f"""
SELECT max(committed_at) AS max_value,
       CAST(date_sub('second', max(committed_at), TIMESTAMP '{CHECK_NOW}') AS DOUBLE) / 3600.0 AS age_hours,
       CASE WHEN max(committed_at) IS NOT NULL
             AND date_sub('second', max(committed_at), TIMESTAMP '{CHECK_NOW}') <= 172800 THEN 'pass'
            ELSE 'fail' END AS status
FROM fct_commits""", "fct_commits"))
def dq_recency(w):
    """DQ-06: newest commit within 48 hours of "now"."""
    return Q.check_recency(w.fct_commits, "committed_at", CHECK_NOW, 48)


@register("dq_range_rows", O.sql("""
SELECT 'stg_languages' AS model, repo_full_name || '/' || language_name AS row_key
FROM stg_languages WHERE language_percentage IS NOT NULL AND (language_percentage < 0 OR language_percentage > 1)
UNION ALL
SELECT 'fct_commits', commit_sha FROM fct_commits
WHERE hour_of_day IS NOT NULL AND (hour_of_day < 0 OR hour_of_day > 23)
UNION ALL
SELECT 'stg_commits', commit_sha FROM stg_commits WHERE lines_added IS NOT NULL AND lines_added > 40""",
    "stg_languages", "fct_commits", "stg_commits"))
def dq_range_rows(w):
    """DQ-07 failing rows: shares outside [0, 1], hours outside [0, 23], and
    commits adding more than 40 lines (a threshold that does fire on the data)."""
    a = Q.check_range(w.stg_languages, "language_percentage", 0, 1).select(
        F.lit("stg_languages").alias("model"),
        F.concat("repo_full_name", F.lit("/"), "language_name").alias("row_key"))
    b = Q.check_range(w.fct_commits, "hour_of_day", 0, 23).select(
        F.lit("fct_commits").alias("model"), F.col("commit_sha").alias("row_key"))
    c = Q.check_range(w.stg_commits, "lines_added", None, 40).select(
        F.lit("stg_commits").alias("model"), F.col("commit_sha").alias("row_key"))
    return a.unionByName(b).unionByName(c)


_COVERAGE = (
    ("commits", "fct_commits", "count(*)", "raw_commits", "count(DISTINCT sha)",
     ("sha",)),
    ("pull_requests", "fct_pull_requests", "count(*)", "raw_pull_requests",
     "count(DISTINCT (repo_full_name, number))", ("repo_full_name", "number")),
    ("reviews", "fct_reviews", "count(*)", "raw_reviews", "count(DISTINCT id)", ("id",)),
    ("repositories", "dim_repository", "count(*)", "raw_repositories", "count(DISTINCT id)", ("id",)),
    ("languages", "stg_languages", "count(*)", "raw_languages",
     "count(DISTINCT (repo_full_name, language_name))", ("repo_full_name", "language_name")),
)


@register("dq_coverage", O.sql("""
SELECT entity, warehouse_rows, source_rows,
       CAST(warehouse_rows AS DOUBLE) / nullif(CAST(source_rows AS DOUBLE), 0) AS coverage,
       coalesce(CAST(warehouse_rows AS DOUBLE) / nullif(CAST(source_rows AS DOUBLE), 0) > 0.9, false) AS meets_target
FROM (""" + "\nUNION ALL\n".join(
    f"SELECT '{e}' AS entity, (SELECT {wc} FROM {wt}) AS warehouse_rows, (SELECT {sc} FROM {st}) AS source_rows"
    for e, wt, wc, st, sc, _ in _COVERAGE) + ")",
    *sorted({x for e, wt, _, st, _, _ in _COVERAGE for x in (wt, st)})))
def dq_coverage(w):
    """DQ-09: warehouse rows over distinct source keys per entity (target > 90 %)."""
    parts = []
    for e, wt, _, st, _, keys in _COVERAGE:
        wr = getattr(w, wt).agg(F.count(F.lit(1)).alias("warehouse_rows"))
        sr = getattr(w, st).select(*keys).distinct().agg(F.count(F.lit(1)).alias("source_rows"))
        parts.append(wr.select(F.lit(e).alias("entity"), "warehouse_rows",
                               sr.select("source_rows").scalar().alias("source_rows")))
    return Q.coverage(reduce(DataFrame.unionByName, parts))


def _landed_sql(entity: str, table: str) -> str:
    repo = "CAST(NULL AS VARCHAR)" if entity == "repositories" else "repo_full_name"
    keys = ", ".join([*ROW_KEYS[table], "ingestion_timestamp"])
    return f"""
SELECT '{entity}' AS entity, {repo} AS repo_full_name, count(*) AS landed, 0 AS loaded
FROM landed_{entity} GROUP BY 2
UNION ALL
SELECT '{entity}', repo, 0, count(*) FROM (SELECT DISTINCT {repo} AS repo, {keys} FROM {table}) GROUP BY repo"""


@register("dq_landed_coverage", O.sql("""
SELECT entity, repo_full_name, CAST(sum(landed) AS BIGINT) AS landed, CAST(sum(loaded) AS BIGINT) AS loaded,
       CAST(sum(loaded) AS DOUBLE) / nullif(CAST(sum(landed) AS DOUBLE), 0) AS ratio,
       coalesce(CAST(sum(loaded) AS DOUBLE) / nullif(CAST(sum(landed) AS DOUBLE), 0) > 0.9, false) AS meets_target
FROM (""" + "\nUNION ALL\n".join(_landed_sql(e, t) for e, t in ENTITIES.items()) + ") GROUP BY entity, repo_full_name",
    *[x for e, t in ENTITIES.items() for x in (f"landed_{e}", t)]))
def dq_landed_coverage(w):
    """DQ-09 by (entity, repository): rows of the raw tables over the objects
    that landed, as a ledger of files counts them."""
    ledgers = {}
    for e, t in ENTITIES.items():
        repo = F.lit(None).cast("string") if e == "repositories" else F.col("repo_full_name")
        ledgers[e] = w.landed(t).select(repo.alias("repoFullName")).groupBy("repoFullName").agg(F.count(F.lit(1)).alias("records"))
    raw = {e: w.raw(t).withColumn(LANDED_AT, F.col("ingestion_timestamp")) for e, t in ENTITIES.items()}
    return Q.landed_coverage(ledgers, raw)
