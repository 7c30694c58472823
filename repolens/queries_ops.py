"""Registered operator queries: raw scans, load metrics, incremental
filters, merge and backfill, run accounting and data quality."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .catalog import O, register
from .context import scratch_dir
from .functions.scalar import safe_timestamp
from .operators import incremental as INC
from .operators import merge as M
from .operators import quality as Q
from .operators import runlog as RUN
from .operators import versioned as V
from .operators.ingest import load_metrics, split_valid
from .plans import mart, staging
from .schemas import ENTITIES, FACT_EVENT_TS, FACT_KEY, REQUIRED

# Parameters of the registered incremental scenario (fixed so results are reproducible).
COMMITS_SINCE = "2024-01-15 12:00:00"
PRS_SINCE = "2024-06-01 00:00:00"
BATCH1_CUTOFF = "2024-02-01 02:00:00"      # first load = rows ingested up to here
BACKFILL_DAYS = {"fct_commits": ("2024-01-10", "2024-01-20"), "fct_pull_requests": ("2021-01-01", "2021-12-31"),
                 "fct_reviews": ("2021-01-01", "2021-12-31")}
CHECK_NOW = "2024-02-03 14:00:00"          # "now" for freshness and recency
RUNS_AS_OF = "2024-02-02"

# ------------------------------------------------------------------ raw scans (SRC-07)
for _t in ("raw_commits", "raw_pull_requests", "raw_reviews", "raw_repositories", "raw_languages"):
    register(_t, O.select_all(_t))(lambda w, _n=_t: w.build(_n))


# ------------------------------------------------------------------ MRT-01 on used dates
@register("dim_date_active", O.sql("""
SELECT * FROM dim_date d WHERE d.date_key IN (
  SELECT date_key FROM fct_commits UNION SELECT created_date_key FROM fct_pull_requests
  UNION SELECT merged_date_key FROM fct_pull_requests UNION SELECT date_key FROM fct_reviews)""",
    "dim_date", "fct_commits", "fct_pull_requests", "fct_reviews"))
def dim_date_active(w):
    """The date dimension restricted to days the facts reference."""
    keys = (w.fct_commits.select("date_key")
            .unionByName(w.fct_pull_requests.select(F.col("created_date_key").alias("date_key")))
            .unionByName(w.fct_pull_requests.select(F.col("merged_date_key").alias("date_key")))
            .unionByName(w.fct_reviews.select("date_key")))
    return w.dim_date.join(keys, "date_key", "left_semi")


# ------------------------------------------------------------------ ING-07/08
def _metrics_sql(table: str) -> str:
    req = REQUIRED[table]
    n_err = " + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in req)
    return (f"SELECT '{table}' AS table_name, count(*) AS total_rows, "
            f"count(*) FILTER (WHERE ({n_err}) = 0) AS successful_rows, "
            f"count(*) FILTER (WHERE ({n_err}) > 0) AS failed_rows, "
            f"CAST(coalesce(sum({n_err}), 0) AS BIGINT) AS error_count FROM {_landed(table)}")


def _landed(table: str) -> str:
    return table.replace("raw_", "landed_")


@register("ing_load_metrics", O.sql("\nUNION ALL\n".join(_metrics_sql(t) for t in REQUIRED), *map(_landed, REQUIRED)))
def ing_load_metrics(w):
    """Load metrics of what landed for each raw table against its REQUIRED columns."""
    parts = [load_metrics(w.landed(t), t).select(F.lit(t).alias("table_name"), "*") for t in REQUIRED]
    return reduce(DataFrame.unionByName, parts)


# what identifies a rejected row: table -> columns
_REJECTED = {"raw_commits": ("repo_full_name", "author_name", "author_date"), "raw_pull_requests": ("repo_full_name", "title", "created_at"),
             "raw_reviews": ("repo_full_name", "user_login", "submitted_at"), "raw_repositories": ("full_name", "name", "created_at"),
             "raw_languages": ("repo_full_name", "language_name", "ingestion_timestamp")}


def _rejected_sql(table: str) -> str:
    reasons = ", ".join(f"CASE WHEN {c} IS NULL THEN 'required field {c} is null' END" for c in REQUIRED[table])
    repo, what, at = _REJECTED[table]
    return (f"SELECT '{table}' AS table_name, {repo} AS repo_full_name, {what} AS what, {at} AS at, "
            f"concat_ws('; ', {reasons}) AS errors FROM {_landed(table)} "
            f"WHERE {' OR '.join(f'{c} IS NULL' for c in REQUIRED[table])}")


@register("ing_rejected_rows", O.sql("\nUNION ALL\n".join(map(_rejected_sql, REQUIRED)), *map(_landed, REQUIRED)))
def ing_rejected_rows(w):
    """ING-07: the landed rows that the load rejects, with their reasons."""
    parts = []
    for t in REQUIRED:
        repo, what, at = _REJECTED[t]
        bad = split_valid(w.landed(t), t)[1]
        parts.append(bad.select(F.lit(t).alias("table_name"), F.col(repo).alias("repo_full_name"), F.col(what).alias("what"),
                                F.col(at).alias("at"), F.array_join("errors", "; ").alias("errors")))
    return reduce(DataFrame.unionByName, parts)


# ------------------------------------------------------------------ SCL-01 on text
@register("scl_safe_timestamps", """
SELECT event_id, txt, TRY_CAST(txt AS TIMESTAMP) AS parsed FROM (
  SELECT event_id, CASE event_id % 7 WHEN 0 THEN 'not a date' WHEN 1 THEN '2024-13-45 00:00:00' WHEN 2 THEN NULL
                   WHEN 3 THEN '' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS txt FROM events)""")
def scl_safe_timestamps(w):
    """Text that is a timestamp, junk, empty or missing."""
    k = F.col("event_id") % 7
    txt = (F.when(k == 0, "not a date").when(k == 1, "2024-13-45 00:00:00").when(k == 2, F.lit(None).cast("string"))
           .when(k == 3, "").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))
    return w.tables("events").select("event_id", txt.alias("txt")).withColumn("parsed", safe_timestamp("txt"))


# ------------------------------------------------------------------ INC-03/04/05
@register("inc_since_commits", O.sql(f"""
SELECT * FROM raw_commits
WHERE TRY_CAST(author_date AS TIMESTAMP) IS NULL OR TRY_CAST(author_date AS TIMESTAMP) > TIMESTAMP '{COMMITS_SINCE}'""",
    "raw_commits"))
def inc_since_commits(w):
    return INC.since_commits(w.raw_commits, COMMITS_SINCE)


_PR_SINCE_COND = (f"(TRY_CAST(updated_at AS TIMESTAMP) IS NULL "
                  f"OR TRY_CAST(updated_at AS TIMESTAMP) > TIMESTAMP '{PRS_SINCE}')")


@register("inc_since_pull_requests", O.sql(f"SELECT * FROM raw_pull_requests WHERE {_PR_SINCE_COND}",
                                           "raw_pull_requests"))
def inc_since_pull_requests(w):
    return INC.since_pull_requests(w.raw_pull_requests, PRS_SINCE)


@register("inc_reviews_in_scope", O.sql(f"""
SELECT * FROM raw_reviews r WHERE EXISTS (
  SELECT 1 FROM raw_pull_requests p
  WHERE {_PR_SINCE_COND} AND p.repo_full_name = r.repo_full_name AND p.number = r.pr_number)""",
    "raw_reviews", "raw_pull_requests"))
def inc_reviews_in_scope(w):
    return INC.reviews_in_scope(w.raw_reviews, INC.since_pull_requests(w.raw_pull_requests, PRS_SINCE))


# ------------------------------------------------------------------ INC-08/09/10
# fact -> (staging model, raw table, merge key, event time)
_FACTS = {f: (f.replace("fct_", "stg_"), f.replace("fct_", "raw_"), FACT_KEY[f], FACT_EVENT_TS[f])
          for f in ("fct_commits", "fct_pull_requests", "fct_reviews")}

# the target (rows of the first load only), the newer staged rows, their facts, and the facts of the backfilled days
for _f, (_s, _r, _k, _ts) in _FACTS.items():
    O.cte(f"{_r}_b1", f"SELECT * FROM {_r} WHERE ingestion_timestamp <= TIMESTAMP '{BATCH1_CUTOFF}'", _r)
    O.variant(f"{_s}_b1", _s, {_r: f"{_r}_b1"})
    O.variant(f"{_f}_b1", _f, {_s: f"{_s}_b1"})
    O.cte(f"{_s}_new", f"""
SELECT * FROM {_s} WHERE ingestion_timestamp > (SELECT max(ingestion_timestamp) FROM {_f}_b1)""", _s, f"{_f}_b1")
    O.variant(f"{_f}_new", _f, {_s: f"{_s}_new"})
    O.cte(f"{_f}_days", f"""
SELECT * FROM {_f} WHERE CAST({_ts} AS DATE) BETWEEN DATE '{BACKFILL_DAYS[_f][0]}' AND DATE '{BACKFILL_DAYS[_f][1]}'""", _f)


# fact -> merge key and event time of its staged rows
_STAGED = {"fct_commits": (["commit_sha"], "authored_at"), "fct_reviews": (["review_id"], "submitted_at"),
           "fct_pull_requests": (["repo_full_name", "pr_number"], "created_at")}


def _staged(name: str, raw: DataFrame, since=None) -> DataFrame:
    """The staged rows of ``raw`` newer than ``since``.  Raw rows have their
    REQUIRED columns; a merge's join would say so of its source's keys alone,
    and the source's rows be shuffled a second time for the keys."""
    stg, table, _, _ = _FACTS[name]
    for c in REQUIRED[table]:
        raw = raw.filter(F.col(c).isNotNull())
    return getattr(staging, stg)(raw, since)


def _of_staged(w, name: str, staged: DataFrame) -> DataFrame:
    """The fact ``name`` of staged rows.  It looks each row up by itself and
    keeps the key and the event time, so rows may be merged before or after:
    before, they are still dealt by their key from the de-duplication, those
    that the merge replaces are not looked up, and both sides are at once."""
    more = [w.fct_pull_requests] if name == "fct_reviews" else []
    return getattr(mart, name)(staged, w.dim_repository, w.dim_date, *more)


def _fact(w, name: str, raw: DataFrame, since=None) -> DataFrame:
    """The fact ``name`` built from the rows of ``raw`` newer than ``since``."""
    return _of_staged(w, name, _staged(name, raw, since))


def _first_batch(w, name: str) -> DataFrame:
    """Raw rows of the first load."""
    return w.table(_FACTS[name][1], partitioned=True).filter(
        F.col("ingestion_timestamp") <= F.lit(BATCH1_CUTOFF).cast("timestamp_ntz"))


def _mark(w, name: str):
    """High-water mark of the first load: staging keeps the newest row of
    each key, so the fact's newest row is the newest raw row, and one narrow
    aggregate over the raw rows gives it without building the fact."""
    return M.high_water_mark(_first_batch(w, name))


def newer_than_target(w, name: str) -> DataFrame:
    """Staged rows newer than the first load's mark; the mark is applied
    below the de-duplication (equivalent, and it prunes)."""
    stg, raw, _, _ = _FACTS[name]
    state, mark = _mark(w, name)
    staged = getattr(staging, stg)(w.table(raw, partitioned=True), since=mark)
    return staged if state == "mark" else staged.limit(0)   # an empty target takes nothing, as in the source


def merge_newer(w, name: str) -> DataFrame:
    """The first load's fact, merged with the facts of newer raw rows."""
    raw = w.table(_FACTS[name][1], partitioned=True)
    state, mark = _mark(w, name)
    src = _staged(name, raw, mark)
    return _of_staged(w, name, M.merge_into(_staged(name, _first_batch(w, name)),
                                            src if state == "mark" else src.limit(0), _STAGED[name][0]))


def backfill_days(w, name: str) -> DataFrame:
    """The first load's fact, its backfilled days replaced by the whole
    history's, which are rebuilt from the raw rows."""
    key, ts = _STAGED[name]
    whole = _staged(name, w.table(_FACTS[name][1], partitioned=True))
    return _of_staged(w, name, M.backfill(_staged(name, _first_batch(w, name)), whole, key, ts, *BACKFILL_DAYS[name]))


def _merge_sql(target: str, src: str, key: str) -> str:
    return O.sql(f"""
SELECT * FROM {target} t WHERE NOT EXISTS (SELECT 1 FROM {src} s WHERE s.{key} = t.{key})
UNION ALL SELECT * FROM {src}""", target, src)


def _written_fact(w, name: str, work) -> DataFrame:
    """The first load's fact as a published table in the shared folder, read
    again after ``work(path)`` wrote to it."""
    _, _, key, ts = _FACTS[name]
    path = f"{scratch_dir(w.spark)}/{name}-{uuid.uuid4().hex}"
    M.write_full(w.spark, _fact(w, name, _first_batch(w, name)), path, key, ts)
    work(path)
    return V.read(w.spark, path).drop(M.EVENT_MONTH)


def written_merge(w, name: str) -> DataFrame:
    """INC-09 as a job: newer rows merged into the published fact."""
    _, raw, key, ts = _FACTS[name]
    state, mark = _mark(w, name)
    src = _fact(w, name, w.table(raw, partitioned=True), mark)
    return _written_fact(w, name, lambda path: M.write_merged(
        w.spark, src if state == "mark" else src.limit(0), path, key, ts))


def written_backfill(w, name: str) -> DataFrame:
    """INC-10 as a job: the whole history's rows of some days, rebuilt from the
    raw rows, merged into the published fact, in one commit."""
    _, raw, key, ts = _FACTS[name]
    first, last = BACKFILL_DAYS[name]
    days = F.to_date(_STAGED[name][1]).between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    whole = _of_staged(w, name, _staged(name, w.table(raw, partitioned=True)).filter(days))
    return _written_fact(w, name, lambda path: M.write_merged(w.spark, whole, path, key, ts))


for _f, (_s, _r, _k, _ts) in _FACTS.items():
    _e = _f.replace("fct_", "")
    register(f"inc_written_merge_{_e}", _merge_sql(f"{_f}_b1", f"{_f}_new", _k))(lambda w, _n=_f: written_merge(w, _n))
    register(f"inc_written_backfill_{_e}", _merge_sql(f"{_f}_b1", f"{_f}_days", _k))(
        lambda w, _n=_f: written_backfill(w, _n))
    register("inc_newer_than_target" + ("" if _e == "commits" else f"_{_e}"), O.select_all(f"{_s}_new"))(
        lambda w, _n=_f: newer_than_target(w, _n))
    register(f"inc_merge_{_e}", _merge_sql(f"{_f}_b1", f"{_f}_new", _k))(lambda w, _n=_f: merge_newer(w, _n))
    register(f"inc_backfill_{_e}", _merge_sql(f"{_f}_b1", f"{_f}_days", _k))(lambda w, _n=_f: backfill_days(w, _n))


# ------------------------------------------------------------------ run log (RUN-01..04, INC-07, DQ-10)
_REPO_COL = {t: ("full_name" if t == "raw_repositories" else "repo_full_name") for t in ENTITIES.values()}


def _run_log_sql(entity: str, table: str) -> str:
    repo = _REPO_COL[table]
    ok = " AND ".join(f"{c} IS NOT NULL" for c in REQUIRED[table])
    loaded = "count(*)" if entity in ("repositories", "pull_requests") else f"count(*) FILTER (WHERE {ok})"
    fails = f"{repo} LIKE '%7'" if entity in ("commits", "pull_requests") else "false"
    return (f"SELECT '{entity}' AS entityType, {repo} AS repoFullName, "
            f"CASE WHEN {fails} THEN 0 ELSE CAST(count(*) AS BIGINT) END AS recordsExtracted, "
            f"CASE WHEN {fails} THEN 0 ELSE CAST({loaded} AS BIGINT) END AS recordsLoaded, NOT ({fails}) AS success, "
            f"CASE WHEN {fails} THEN '502 Bad Gateway: ' || {repo} END AS errorMessage, "
            f"CAST(NULL AS BIGINT) AS durationMs FROM {_landed(table)} GROUP BY {repo}")


O.cte("run_log", "\nUNION ALL\n".join(_run_log_sql(e, t) for e, t in ENTITIES.items()), *map(_landed, ENTITIES.values()))


@register("run_log", O.select_all("run_log"))
def run_log(w):
    return w.build("run_log")


@register("run_counts", O.sql("""
SELECT count(*) FILTER (WHERE success) AS success_count, count(*) FILTER (WHERE NOT success) AS failure_count,
       coalesce(bool_or(NOT success), false) AS has_failures FROM run_log""", "run_log"))
def run_counts(w):
    return RUN.run_counts(w.run_log)


@register("run_by_entity", O.sql("""
SELECT e.entityType, coalesce(g.extracted, 0) AS extracted, coalesce(g.loaded, 0) AS loaded,
       coalesce(g.failures, 0) AS failures
FROM (VALUES ('repositories'), ('commits'), ('pull_requests'), ('reviews'), ('languages')) e(entityType)
LEFT JOIN (SELECT entityType,
                  CAST(sum(CASE WHEN success THEN recordsExtracted END) AS BIGINT) AS extracted,
                  CAST(sum(CASE WHEN success THEN recordsLoaded END) AS BIGINT) AS loaded,
                  count(*) FILTER (WHERE NOT success) AS failures
           FROM run_log GROUP BY entityType) g USING (entityType)""", "run_log"))
def run_by_entity(w):
    return RUN.run_by_entity(w.spark, w.run_log)


@register("run_failures", O.sql("SELECT entityType, repoFullName, errorMessage FROM run_log WHERE NOT success",
                                "run_log"))
def run_failures(w):
    return RUN.run_failures(w.run_log)


@register("inc_advanceable", O.sql("""
SELECT entityType, bool_or(success) AS any_success, bool_and(success) AS all_success,
       bool_or(success) AND bool_and(success) AS advance
FROM run_log GROUP BY entityType""", "run_log"))
def inc_advanceable(w):
    return INC.advanceable_entities(w.run_log)


def derived_daily_runs(w) -> DataFrame:
    """One run per (entity, ingestion day) of the raw tables."""
    parts = [w.raw(t).select(F.lit(e).alias("entity"), F.to_date("ingestion_timestamp").alias("run_date"))
             for e, t in ENTITIES.items()]
    # runs of reviews and languages fail on the 7th, 17th and 27th
    failed = F.col("entity").isin("reviews", "languages") & (F.dayofmonth("run_date") % 10 == 7)
    return reduce(DataFrame.unionByName, parts).distinct().withColumn("success", ~failed)


@register("dq_success_rate", O.sql(f"""
SELECT count(*) AS runs, count(*) FILTER (WHERE success) AS successful_runs,
       CAST(count(*) FILTER (WHERE success) AS DOUBLE) / nullif(count(*), 0) AS success_rate,
       coalesce(CAST(count(*) FILTER (WHERE success) AS DOUBLE) / nullif(count(*), 0) > 0.95, false) AS meets_target
FROM (SELECT DISTINCT * FROM (""" + "\nUNION ALL\n".join(
    f"SELECT '{e}' AS entity, CAST(ingestion_timestamp AS DATE) AS run_date, "
    f"NOT ('{e}' IN ('reviews', 'languages') AND day(CAST(ingestion_timestamp AS DATE)) % 10 = 7) AS success FROM {t}"
    for e, t in ENTITIES.items()) + f"""))
WHERE run_date > DATE '{RUNS_AS_OF}' - 30 AND run_date <= DATE '{RUNS_AS_OF}'""", *ENTITIES.values()))
def dq_success_rate(w):
    return Q.success_rate(derived_daily_runs(w), RUNS_AS_OF)
