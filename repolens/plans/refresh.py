"""Jobs that write: the ingest run (landed JSON -> raw tables) and the
mart refresh (raw -> staging -> dimensions and incremental facts).

Lineage is cut by writing: every layer is read back from the tables it
was written to (in the warehouse root, shared storage on a cluster), so
a lost executor recomputes at most one layer.
"""

from __future__ import annotations

import datetime as _dt
import logging
import time
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import safe_timestamp
from ..operators import incremental as INC
from ..operators import ingest as ING
from ..operators import merge as M
from ..operators import runlog as RUN
from ..operators import sinks
from ..operators import versioned as V
from ..operators.dedup import latest_per_key
from ..schemas import ENTITIES, FACT_EVENT_TS, FACT_KEY, LEDGER_SCHEMA, RUN_LOG_SCHEMA
from ..sources import landing as L
from . import analytics, mart, staging

_FLATTEN = {
    "repositories": lambda df: ING.to_raw_repositories(df),
    "commits": lambda df: ING.to_raw_commits(df),
    "pull_requests": lambda df: ING.to_raw_pull_requests(df),
    "reviews": lambda df: ING.to_raw_reviews(df),
    "languages": lambda df: ING.to_raw_languages(df),
}

_LOG = logging.getLogger(__name__)

ORDER = ("repositories", "commits", "pull_requests", "reviews", "languages")
PRS_FAILED = "pull request step failed; reviews not extracted"
CHAINS = (("pull_requests", "reviews"), ("commits",), ("languages",))


def _utcnow() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


def run_ingest(spark: SparkSession, landing: str, root: str, full: bool = False,
               run_instant: _dt.datetime | None = None, reviews_need_prs: bool = True) -> DataFrame:
    """INC-06 / RUN-05: load the landed JSON into the raw tables.

    * Repositories come first; the other entities are read for the listed
      repositories only (those of this run's pages, else of the newest run that
      had some).  Without a list nothing else is loaded.
    * Each landed file is read once: files that the ledger names with the same
      modification time are left out before anything is read.  ``full=True``
      reads all files and ignores the watermarks (but still advances them).
    * Commits are kept when authored after the commits watermark, PRs when
      updated after the PR watermark (unknown instants are kept), reviews
      only for PRs in scope; a file with reviews of other PRs is read again in
      the run that brings these into scope.
    * A step is one entity of one repository.  A malformed page fails its step:
      none of the step's rows is loaded, none of its files enters the ledger
      (so a mended one is loaded later), the run log names the file, and all
      other steps go on.  What concerns an entity as a whole (its folder is
      missing) fails all its steps; a setup failure stops the run with a
      single ``infrastructure`` row.
    * A watermark advances to the run instant (taken before loading) only
      for entities with at least one successful step and no failure.
    * Rows that miss REQUIRED columns are appended with their reasons to
      ``raw/_rejected/<table>``; "loaded" does not count them.
    * The review step of a repository fails when its PR step failed;
      reviews_need_prs=False reports zero loaded reviews as success instead
      (their files wait for a later run).
    Returns the run log (``RUN_LOG_SCHEMA``).
    """
    run_instant = run_instant or _utcnow()
    run = f"run={run_instant.strftime('%Y%m%dT%H%M%S%f')}"
    log_path = f"{root.rstrip('/')}/raw/_run_log/{run}"
    try:
        sinks.ensure_layers(spark, root)
        sinks.ensure_tables(spark, root)
        marks = {e: None if full else INC.get_watermark(spark, root, e) for e in ("commits", "pull_requests")}
    except Exception as e:  # setup failure stops the run
        return RUN.result_rows(spark, [("infrastructure", None, 0, 0, False, str(e), 0)])

    step = _Steps(spark, landing, root, full, run_instant, run, log_path, marks, reviews_need_prs)
    try:
        if step.load("repositories"):
            # what does not depend on each other runs side by side; reviews follow the pull requests
            with ThreadPoolExecutor(max_workers=3) as pool:
                chains = [pool.submit(lambda c=chain: [step.load(e) for e in c]) for chain in CHAINS]
                for c in chains:
                    c.result()
    finally:
        sinks.delete(spark, step.failed_path)
    results = spark.read.schema(RUN_LOG_SCHEMA).parquet(*[f"{log_path}/{e}" for e in sinks.list_dirs(spark, log_path)])
    # five rows at most: one per entity
    gate = {r["entityType"]: r["advance"] for r in INC.advanceable_entities(results).collect()}
    advance = {e: run_instant for e in ORDER if gate.get(e)}
    try:
        INC.set_watermarks(spark, root, advance)
    except Exception:   # the next run loads from the old marks again; this run's results stand
        _LOG.exception("watermarks of run %s were not stored", run_instant)
    return results


def ledger_path(root: str, entity: str) -> str:
    return f"{root.rstrip('/')}/raw/_ledger/{entity}"


def read_ledger(spark: SparkSession, root: str, entity: str) -> DataFrame:
    """The newest entry of every loaded (path, modified)."""
    path = ledger_path(root, entity)
    if not sinks.exists(spark, path):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return latest_per_key(spark.read.schema(LEDGER_SCHEMA).parquet(path), ["path", "modified"], "run", ["kept", "records"])


class _Steps:
    """The steps of one run, entity by entity."""

    def __init__(self, spark, landing, root, full, instant, run, log_path, marks, reviews_need_prs):
        self.spark, self.landing, self.root, self.full = spark, landing, root, full
        self.instant, self.run, self.log_path = instant, run, log_path
        self.marks, self.reviews_need_prs = marks, reviews_need_prs
        self.scope: DataFrame | None = None         # repo_full_name
        self.prs_in_scope: DataFrame | None = None  # repo_full_name, number
        self.failed_prs: DataFrame | None = None    # repo_full_name
        self.failed_path = f"{root.rstrip('/')}/raw/_staging/_failed_prs/{run}"

    def load(self, entity: str) -> bool:
        """Load all steps of an entity; False if none could be."""
        t0 = time.monotonic()
        pages_path = f"{self.root.rstrip('/')}/raw/_staging/{ENTITIES[entity]}/{self.run}"
        try:
            self._load(entity, t0, pages_path)
            return entity != "repositories" or self.scope is not None
        except Exception as e:
            self._log_failures(entity, self.scope, F.lit(str(e)), t0)
            if entity == "pull_requests":
                self.failed_prs = self.scope
            return False
        finally:
            sinks.delete(self.spark, pages_path)

    # ------------------------------------------------------------ files
    def _files(self, entity: str) -> DataFrame:
        """The files to read, written so that later reads agree: path,
        modified, repoFullName."""
        found = L.landed_files(self.spark, self.landing, entity)
        if self.scope is not None:
            found = found.join(self.scope.withColumnRenamed("repo_full_name", "repoFullName"), "repoFullName", "left_semi") \
                .select("path", "modified", "repoFullName")
        if self.full:
            return found
        ledger = read_ledger(self.spark, self.root, entity)
        known = ledger.select("path", "modified")
        if entity == "reviews" and self.prs_in_scope is not None:
            prs = self.prs_in_scope.select(F.col("repo_full_name").alias("repoFullName"), F.col("number").alias("wait"))
            again = (ledger.filter(F.size("waits") > 0).withColumn("wait", F.explode("waits"))
                     .join(prs, ["repoFullName", "wait"], "left_semi").select("path", "modified"))
            known = known.join(again, ["path", "modified"], "left_anti")
        return found.join(known, ["path", "modified"], "left_anti").select("path", "modified", "repoFullName")

    def _load(self, entity: str, t0: float, pages_path: str) -> None:
        spark, table = self.spark, ENTITIES[entity]
        self._files(entity).write.parquet(f"{pages_path}/files")
        files = spark.read.schema("path string, modified timestamp, repoFullName string").parquet(f"{pages_path}/files")
        # names of the new files, as any file reader holds those that it reads
        names = [r["path"] for r in files.select("path").collect()]
        if not names and entity != "repositories":
            return self._nothing_new(entity, t0)
        # the pages are parsed once; steps, counts and appends read them from here
        L.read_files(spark, entity, names).write.parquet(f"{pages_path}/pages")
        pages = spark.read.schema(L.files_schema(entity)).parquet(f"{pages_path}/pages")

        failed = (pages.filter(L.BROKEN).groupBy("repo_full_name").agg(F.min("_file").alias("f"), F.countDistinct("_file").alias("n"))
                  .select("repo_full_name", F.concat(F.lit("malformed page "), "f", F.when(F.col("n") > 1, F.concat(
                      F.lit(" and "), F.col("n") - 1, F.lit(" more"))).otherwise(F.lit(""))).alias("error")))
        if entity == "repositories" and not failed.isEmpty():
            raise ValueError(failed.first()["error"])
        if entity == "reviews" and self.failed_prs is not None:
            failed = failed.unionByName(self.failed_prs.join(failed, "repo_full_name", "left_anti").withColumn(
                "error", F.lit(PRS_FAILED)))
        if entity != "repositories":
            failed.write.parquet(f"{pages_path}/failed")
            failed = spark.read.schema("repo_full_name string, error string").parquet(f"{pages_path}/failed")
            pages = pages.join(failed, "repo_full_name", "left_anti")

        # rows of the steps that did not fail
        rows = _FLATTEN[entity](L.objects(entity, pages))
        kept = rows
        if entity == "commits":
            kept = INC.since_commits(rows, self.marks["commits"])
        elif entity == "pull_requests":
            kept = INC.since_pull_requests(rows, self.marks["pull_requests"])
        elif entity == "reviews":
            kept = rows.limit(0) if self.prs_in_scope is None else INC.reviews_in_scope(rows, self.prs_in_scope)
        kept = ING.stamp(kept, self.instant)
        kept.write.parquet(f"{pages_path}/rows")
        kept = spark.read.schema(kept.schema).parquet(f"{pages_path}/rows")
        ok, bad = ING.split_valid(kept, table)
        sinks.append_rejected(bad.drop("_file"), self.root, table)
        sinks.append_raw(ok.drop("_file"), self.root, table)
        if entity == "repositories":
            self._set_scope(bool(names))
        if entity == "pull_requests":
            # kept beyond this step's staging folder
            failed.select("repo_full_name").write.mode("overwrite").parquet(self.failed_path)
            self.failed_prs = spark.read.schema("repo_full_name string").parquet(self.failed_path)
            self.prs_in_scope = self._loaded_now(table).select("repo_full_name", "number")
        self._log(entity, kept, failed, t0)
        done = files if entity == "repositories" else files.join(
            failed.select(F.col("repo_full_name").alias("repoFullName")), "repoFullName", "left_anti")
        self._enter(entity, done, rows, kept)

    def _nothing_new(self, entity: str, t0: float) -> None:
        """No new file: each listed repository's step succeeds with zero rows,
        or fails with its pull requests."""
        failed = self.scope.limit(0)
        if entity == "pull_requests":
            self.prs_in_scope = self._loaded_now(ENTITIES[entity]).select("repo_full_name", "number")
        elif entity == "reviews" and self.reviews_need_prs and self.failed_prs is not None:
            failed = self.failed_prs
            self._log_failures(entity, failed, F.lit(PRS_FAILED), t0)
        zero = (self.scope.join(failed, "repo_full_name", "left_anti")
                .select("repo_full_name", F.lit(0).alias("total_rows"), F.lit(0).alias("successful_rows")))
        RUN.results_from_metrics(zero, entity, True, None, int((time.monotonic() - t0) * 1000)) \
            .write.mode("append").parquet(f"{self.log_path}/{entity}")

    def _loaded_now(self, table: str) -> DataFrame:
        at = F.lit(self.instant.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
        return sinks.read_raw(self.spark, self.root, table).filter(
            (F.col("ingestion_date") == F.to_date(at)) & (F.col("ingestion_timestamp") == at))

    def _set_scope(self, had_pages: bool) -> None:
        """The listed repositories: of this run, or of the newest run that had
        a list."""
        listed = self._loaded_now("raw_repositories")
        if not had_pages:
            raw = sinks.read_raw(self.spark, self.root, "raw_repositories")
            newest = raw.agg(F.max("ingestion_timestamp").alias("m")).first()["m"]
            if newest:
                at = F.lit(newest.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
                listed = raw.filter((F.col("ingestion_date") == F.to_date(at)) & (F.col("ingestion_timestamp") == at))
        self.scope = listed.select(F.col("full_name").alias("repo_full_name")).filter("repo_full_name IS NOT NULL").distinct()

    # ------------------------------------------------------------ results
    def _log(self, entity: str, kept: DataFrame, failed: DataFrame, t0: float) -> None:
        """One result row per repository (zeros where nothing was loaded) that
        did not fail, and one per repository that did; written, not collected."""
        by = "full_name" if entity == "repositories" else "repo_full_name"
        m = ING.load_metrics(kept.withColumnRenamed(by, "repo_full_name"), ENTITIES[entity], by=["repo_full_name"])
        if entity != "repositories":
            listed = self.scope.join(failed, "repo_full_name", "left_anti")
            m = m.join(listed, "repo_full_name", "full").na.fill(0, ["total_rows", "successful_rows"])
        elif m.isEmpty():
            m = self.spark.createDataFrame([(None, 0, 0)], "repo_full_name string, total_rows bigint, successful_rows bigint")
        took = int((time.monotonic() - t0) * 1000)
        RUN.results_from_metrics(m, entity, True, None, took).write.mode("append").parquet(f"{self.log_path}/{entity}")
        if entity == "repositories":
            return
        if entity == "reviews" and not self.reviews_need_prs and self.failed_prs is not None:
            waiting = failed.join(self.failed_prs, "repo_full_name", "left_semi")
            zero = waiting.select("repo_full_name", F.lit(0).alias("total_rows"), F.lit(0).alias("successful_rows"))
            RUN.results_from_metrics(zero, entity, True, None, took).write.mode("append").parquet(f"{self.log_path}/{entity}")
            failed = failed.join(self.failed_prs, "repo_full_name", "left_anti")
        self._log_failures(entity, failed.select("repo_full_name", "error"), F.col("error"), t0)

    def _log_failures(self, entity: str, repos: DataFrame | None, error, t0: float) -> None:
        if repos is None or entity == "repositories":
            repos = self.spark.createDataFrame([(None,)], "repo_full_name string")
        repos.select(F.lit(entity).alias("entityType"), F.col("repo_full_name").alias("repoFullName"),
                     F.lit(0).cast("bigint").alias("recordsExtracted"), F.lit(0).cast("bigint").alias("recordsLoaded"),
                     F.lit(False).alias("success"), error.cast("string").alias("errorMessage"),
                     F.lit(int((time.monotonic() - t0) * 1000)).cast("bigint").alias("durationMs")) \
            .write.mode("append").parquet(f"{self.log_path}/{entity}")

    def _enter(self, entity: str, files: DataFrame, rows: DataFrame, kept: DataFrame) -> None:
        """Ledger entries of the files of finished steps, with their counts."""
        per_file = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("records"))
        loaded = kept.groupBy("_file").agg(F.count(F.lit(1)).alias("kept"))
        out = files.join(per_file, files["path"] == per_file["_file"], "left").drop("_file")
        out = out.join(loaded, out["path"] == loaded["_file"], "left").drop("_file")
        if entity == "reviews":
            out_of_scope = rows if self.prs_in_scope is None else rows.join(
                self.prs_in_scope.select(F.col("repo_full_name"), F.col("number").alias("pr_number")),
                ["repo_full_name", "pr_number"], "left_anti")
            waits = out_of_scope.groupBy("_file").agg(F.collect_set("pr_number").alias("waits"))      # of one file
            out = out.join(waits, out["path"] == waits["_file"], "left").drop("_file")
        else:
            out = out.withColumn("waits", F.lit(None).cast("array<bigint>"))
        zero = F.lit(0).cast("bigint")
        out.select("path", "modified", "repoFullName", F.coalesce("records", zero).alias("records"),
                   F.coalesce("kept", zero).alias("kept"), "waits",
                   F.lit(self.instant.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz").alias("run")) \
            .write.mode("append").parquet(ledger_path(self.root, entity))


# ----------------------------------------------------------------- mart refresh


def _path(root: str, layer: str, name: str) -> str:
    return sinks.table_path(root, layer, name)


def read_table(spark: SparkSession, root: str, layer: str, name: str, parts=None) -> DataFrame:
    """The published version of a table; facts and monthly aggregates carry
    their month column, and ``parts`` limits the read to some months."""
    return V.read(spark, _path(root, layer, name), parts)


FACTS = ("fct_commits", "fct_pull_requests", "fct_reviews")
_RAW_KEY = {"fct_commits": "sha", "fct_pull_requests": "concat(repo_full_name, '#', CAST(number AS STRING))", "fct_reviews": "id"}
_RAW_EVENT = {"fct_commits": "author_date", "fct_pull_requests": "created_at", "fct_reviews": "submitted_at"}


def _build(spark: SparkSession, root: str, name: str, raw: DataFrame, since=None) -> DataFrame:
    """The fact ``name`` from raw rows (newer than ``since``) and the
    published dimensions; reviews look up the published PR fact."""
    dims = read_table(spark, root, "mart", "dim_repository"), read_table(spark, root, "mart", "dim_date")
    stg = getattr(staging, name.replace("fct_", "stg_"))(raw, since)
    if name == "fct_reviews":
        return mart.fct_reviews(stg, *dims, read_table(spark, root, "mart", "fct_pull_requests").drop(M.EVENT_MONTH))
    return getattr(mart, name)(stg, *dims)


def refresh_mart(spark: SparkSession, root: str, dim_start=mart.DEFAULT_START, dim_end=None,
                 full_refresh: bool = False, aggregates: bool = True) -> dict:
    """Build dimensions (full refresh) and merge new rows into the facts.

    Every table is published in one commit (``operators.versioned``): readers
    and a job that fails see the version before it.  A fact that does not
    exist yet (or ``full_refresh``) is built from all raw rows; otherwise only
    raw rows newer than the fact's high-water mark are staged (the mark is
    applied below the de-duplication and on the day partition column), and
    the result is merged into the touched month partitions.  The mark is
    stored after a merge is published, so a merge that broke off is done
    again; an empty fact is built from all raw rows.  Facts are built in
    dependency order: reviews look up the PR fact published in the same run.
    The aggregates follow for the touched months alone.
    """
    raw = {t: sinks.read_raw(spark, root, t) for t in ENTITIES.values()}
    report: dict = {}
    V.publish(spark, mart.dim_date(spark, dim_start, dim_end), _path(root, "mart", "dim_date"))
    V.publish(spark, mart.dim_repository(staging.stg_repositories(raw["raw_repositories"])),
              _path(root, "mart", "dim_repository"))
    V.publish(spark, staging.stg_languages(raw["raw_languages"]), _path(root, "staging", "stg_languages"))

    for name in FACTS:
        path = _path(root, "mart", name)
        # the mark stored after the last published build or merge; a read error must not rebuild the fact
        mark = INC.get_watermark(spark, root, name, strict=True) if V.exists(spark, path) else None
        src = _build(spark, root, name, raw[name.replace("fct_", "raw_")], None if full_refresh else mark)
        write = M.write_full if full_refresh or mark is None else M.write_merged
        report[name] = write(spark, src, path, FACT_KEY[name], FACT_EVENT_TS[name])
        state, mark = M.high_water_mark(read_table(spark, root, "mart", name))
        if state == "mark":
            INC.set_watermarks(spark, root, {name: mark})
    if aggregates:
        report["aggregates"] = refresh_aggregates(spark, root, {n: report[n].get("touched") for n in FACTS})
    return report


def backfill(spark: SparkSession, root: str, name: str, start, end, aggregates: bool = True) -> dict:
    """INC-10: rebuild the fact rows of the days ``start``..``end``
    (inclusive) from all raw rows and publish them in one commit.

    The keys are those with any raw row in these days and those that the fact
    has there; each is rebuilt from all of its raw rows.  Rows that fall in the
    days are merged; so are those of keys that the fact has there although
    their newest row lies elsewhere.  Months that get no such row keep their
    files."""
    key, ts, path = FACT_KEY[name], FACT_EVENT_TS[name], _path(root, "mart", name)
    raw = sinks.read_raw(spark, root, name.replace("fct_", "raw_")).withColumn("_key", F.expr(_RAW_KEY[name]))
    first, last = (F.lit(str(d)).cast("date") for d in (start, end))
    inside = F.coalesce(F.to_date(ts).between(first, last), F.lit(False))
    months = [r["part"] for r in V.entries(spark, path) if r["part"] and str(start)[:7] <= r["part"] <= str(end)[:7]]
    there = V.read(spark, path, months).filter(inside).select(F.col(key).alias("_there")).distinct()
    days = F.to_date(safe_timestamp(_RAW_EVENT[name])).between(first, last)
    keys = raw.filter(days).select("_key").union(there).distinct()
    rebuilt = _build(spark, root, name, raw.join(keys, "_key", "left_semi").drop("_key"))
    src = (rebuilt.join(there, rebuilt[key] == F.col("_there"), "left")
           .filter(inside | F.col("_there").isNotNull()).drop("_there"))
    report = M.write_merged(spark, src, path, key, ts)
    if aggregates:
        refresh_aggregates(spark, root, {n: report.get("touched") if n == name else [] for n in FACTS})
    return report


def refresh_aggregates(spark: SparkSession, root: str, touched: dict | None = None) -> dict:
    """Bring the aggregate tables up to date.

    ``touched``: per fact the months that a merge published (None: all).
    Rows by (day, repository), by (month, weekday, hour) and by (month,
    language) are kept by month: only the touched months of a fact, and the
    months of language snapshots newer than the last ones seen, are read and
    published anew.  The tables by day, week, month, cell and language are
    rolled up from these; they are small."""
    touched = touched or {}
    paths = {n: _path(root, "mart", n) for n in (
        "agg_activity_day_repo", "agg_commits_by_hour_month", "agg_language_bytes_month")}
    months = {n: touched.get(n) for n in ("fct_commits", "fct_pull_requests")}
    anew = not all(V.exists(spark, p) for p in paths.values()) or any(m is None for m in months.values())
    both = None if anew else sorted({*months["fct_commits"], *months["fct_pull_requests"]}, key=str)
    hours = None if anew else months["fct_commits"]

    def fact(name: str, parts) -> DataFrame:
        return read_table(spark, root, "mart", name, parts)

    if both is None or both:
        day = analytics.activity_by_day_repo(fact("fct_commits", both), fact("fct_pull_requests", both))
        V.publish(spark, M.for_month_write(M.with_event_month(day, "activity_date"), "repo_id"),
                  paths["agg_activity_day_repo"], M.EVENT_MONTH, both)
    if hours is None or hours:
        V.publish(spark, analytics.hour_counts(fact("fct_commits", hours), M.EVENT_MONTH).repartition(M.EVENT_MONTH),
                  paths["agg_commits_by_hour_month"], M.EVENT_MONTH, hours)
    # language snapshots: months with rows newer than the last ones seen
    raw = sinks.read_raw(spark, root, "raw_languages")
    mark = None if anew else INC.get_watermark(spark, root, "agg_language_bytes_month", strict=True)
    newer = staging.newer_than(raw, mark).agg(
        F.max("ingestion_timestamp").alias("mark"),
        F.collect_set(F.date_format("ingestion_timestamp", "yyyy-MM")).alias("months")).first()     # one value a month
    if newer["mark"] is not None or anew:
        snapshots = None if mark is None else newer["months"]
        if snapshots is not None:
            days = F.col("ingestion_date")
            raw = raw.filter(reduce(lambda a, b: a | b, [
                (days >= F.lit(f"{m}-01").cast("date")) & (days < F.add_months(F.lit(f"{m}-01").cast("date"), 1)) for m in snapshots]))
        by = M.with_event_month(analytics.language_bytes_by_month(raw.drop("ingestion_date")), "month_start")
        V.publish(spark, M.for_month_write(by, "language_name"), paths["agg_language_bytes_month"], M.EVENT_MONTH, snapshots)
        if newer["mark"] is not None:
            INC.set_watermarks(spark, root, {"agg_language_bytes_month": newer["mark"]})

    day_repo, hour, language = (V.read(spark, p).drop(M.EVENT_MONTH) for p in paths.values())
    out = {
        "agg_daily_activity": analytics.daily_activity(day_repo),
        "agg_weekly_activity": analytics.weekly_activity(day_repo),
        "agg_monthly_activity": analytics.monthly_activity(day_repo),
        "agg_hourly_heatmap": analytics.heatmap_from(spark, hour),
        "agg_language_usage": analytics.language_usage_from(
            language, analytics.commits_by_month_repo(day_repo), read_table(spark, root, "mart", "dim_repository")),
    }
    for name, df in out.items():
        V.publish(spark, df, _path(root, "mart", name))
    return {"mode": "full" if anew else "merge", "months": both}
