"""The warehouse over the driver's tables, materialised layer by layer.

``Warehouse(spark, sf_dir)`` exposes raw, staging and mart relations.

* ``w.build(name)`` computes one relation from the layer below it (raw
  from the driver's tables, staging from raw, mart from staging and
  dimensions) -- the plan a refresh job runs for that model.
* ``w.<name>`` / ``w.table(name)`` is the *written* table.  On first use
  it and the tables it is computed from (``NEEDS``) are built in order and
  written as parquet under the shared folder named by
  ``spark.checkpoint.dir``, keyed by the input files and this package's
  code; tables that no query asks for are not built.  Readers then start from written tables, so
  lineage is cut at every layer: a lost executor recomputes at most one
  layer, and dashboards read the mart as they would in production
  instead of re-deriving it.

``materialize=False`` keeps everything lazy (one plan from the parquet
inputs to the result).
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import os
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

from .operators import merge, runlog, sinks
from .schemas import FACT_EVENT_TS, FACT_KEY
from .plans import analytics, mart, staging
from .session import CODEC, checkpoint_root, shuffles_dropped
from .sources import fixtures
from .sources.tables import TableSet

# Date dimension range for all registered queries (fixed so results are
# reproducible; production runs pass end=None for today + 365 days).
DIM_START = _dt.date(2020, 1, 1)
DIM_END = _dt.date(2027, 12, 31)

RAW = ("raw_repositories", "raw_commits", "raw_pull_requests", "raw_reviews", "raw_languages")
STAGING = ("stg_repositories", "stg_commits", "stg_pull_requests", "stg_reviews", "stg_languages")
RUN_LOG = ("run_log",)             # result rows of loading the raw tables
MART = ("dim_date", "dim_repository", "fct_commits", "fct_pull_requests", "fct_reviews")
# Aggregate tables the reference specifies as tables (built from the mart).
AGGREGATES = ("agg_activity_day_repo", "agg_language_usage", "agg_hourly_heatmap",
              "agg_daily_activity", "agg_weekly_activity", "agg_monthly_activity")
LAYERS = RAW + STAGING + RUN_LOG + MART + AGGREGATES   # build order
# Dependency waves: tables inside a wave are independent and are written
# by concurrent Spark jobs.
WAVES = (RAW + ("dim_date",), STAGING + RUN_LOG, ("dim_repository",), ("fct_commits", "fct_pull_requests"),
         ("fct_reviews", "agg_activity_day_repo", "agg_language_usage", "agg_hourly_heatmap"),
         ("agg_daily_activity", "agg_weekly_activity", "agg_monthly_activity"))
# The written tables that each table is computed from (see ``build``); those
# not named here come from the driver's tables alone.
NEEDS = {
    "stg_repositories": ("raw_repositories",), "stg_commits": ("raw_commits",), "stg_pull_requests": ("raw_pull_requests",),
    "stg_reviews": ("raw_reviews",), "stg_languages": ("raw_languages",),
    "dim_repository": ("stg_repositories",),
    "fct_commits": ("stg_commits", "dim_repository", "dim_date"),
    "fct_pull_requests": ("stg_pull_requests", "dim_repository", "dim_date"),
    "fct_reviews": ("stg_reviews", "dim_repository", "dim_date", "fct_pull_requests"),
    "agg_activity_day_repo": ("fct_commits", "fct_pull_requests"),
    "agg_language_usage": ("raw_languages", "fct_commits", "dim_repository"),
    "agg_hourly_heatmap": ("fct_commits",),
    "agg_daily_activity": ("agg_activity_day_repo",), "agg_weekly_activity": ("agg_activity_day_repo",),
    "agg_monthly_activity": ("agg_activity_day_repo",),
}
INPUTS = ("customer", "orders", "lineitem", "events", "part")

_PKG = os.path.dirname(os.path.abspath(__file__))
_OWN = ("functions", "operators", "plans", "sources")    # sub-packages whose code decides what a layer holds


def _code_files() -> list[str]:
    return sorted([f for f in os.listdir(_PKG) if f.endswith(".py")]
                  + [f"{d}/{f}" for d in _OWN for f in os.listdir(os.path.join(_PKG, d)) if f.endswith(".py")])


_PARTITION_COLUMN = {t: merge.EVENT_MONTH for t in FACT_EVENT_TS}
_lock = threading.Lock()
_READ_CACHE: dict[tuple[str, str], DataFrame] = {}


def _fingerprint(spark: SparkSession, sf_dir: str, dim_end) -> str:
    h = hashlib.sha256()
    h.update(f"{os.path.abspath(sf_dir) if '://' not in sf_dir else sf_dir}|{dim_end}".encode())
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for t in INPUTS:
        p = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{t}.parquet")
        fs = p.getFileSystem(conf)
        for st in fs.listStatus(p):
            h.update(f"{t}:{st.getPath().getName()}:{st.getLen()}:{st.getModificationTime()}".encode())
    for rel in _code_files():
        h.update(rel.encode())
        with open(os.path.join(_PKG, rel), "rb") as f:
            h.update(f.read())
    return h.hexdigest()[:20]


WAREHOUSE_DIR_CONF = "spark.repolens.warehouseDir"


def _base_dir(spark: SparkSession) -> str:
    """``spark.repolens.warehouseDir`` when set, else a folder inside the
    shared ``spark.checkpoint.dir`` (not the per-context sub-folder Spark
    adds), so written layers are reused across sessions."""
    own = spark.conf.get(WAREHOUSE_DIR_CONF, None)
    if own:
        return own.rstrip("/")
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    return f"{(conf or checkpoint_root(spark)).rstrip('/')}/repolens-warehouse"


def scratch_dir(spark: SparkSession) -> str:
    """Folder beside the written layers for tables that one query writes."""
    return f"{_base_dir(spark)}/_scratch"


def _writer(df: DataFrame) -> DataFrameWriter:
    return df.write.mode("overwrite").option("compression", CODEC)


class Warehouse:
    def __init__(self, spark: SparkSession, sf_dir: str, dim_end=DIM_END, materialize: bool = True):
        self.spark = spark
        self.tables = TableSet(spark, sf_dir)
        self.sf_dir = sf_dir
        self.dim_end = dim_end
        self.materialize = materialize
        self._lazy: dict[str, DataFrame] = {}
        self._root: str | None = None
        self._ready: set[str] = set()       # tables known to be written

    # ------------------------------------------------------------ builders
    def build(self, name: str) -> DataFrame:
        """Compute ``name`` from the layer below (written tables when materialising)."""
        t = self.table
        if name in RAW:
            return fixtures.RAW_BUILDERS[name](self.tables)
        if name == "stg_languages":
            return staging.stg_languages(t("raw_languages"))
        if name in STAGING:
            return staging.STAGING[name][1](t(staging.STAGING[name][0]))
        if name == "run_log":
            return runlog.run_log_from_landed({r: self.landed(r) for r in RAW}, fixtures.step_error)
        if name == "dim_date":
            return mart.dim_date(self.spark, DIM_START, self.dim_end)
        if name == "dim_repository":
            return mart.dim_repository(t("stg_repositories"))
        if name == "fct_commits":
            return mart.fct_commits(t("stg_commits"), t("dim_repository"), t("dim_date"))
        if name == "fct_pull_requests":
            return mart.fct_pull_requests(t("stg_pull_requests"), t("dim_repository"), t("dim_date"))
        if name == "fct_reviews":
            return mart.fct_reviews(t("stg_reviews"), t("dim_repository"), t("dim_date"), t("fct_pull_requests"))
        if name == "agg_activity_day_repo":
            return analytics.activity_by_day_repo(t("fct_commits"), t("fct_pull_requests"))
        if name == "agg_daily_activity":
            return analytics.daily_activity(t("agg_activity_day_repo"))
        if name == "agg_weekly_activity":
            return analytics.weekly_activity(t("agg_activity_day_repo"))
        if name == "agg_monthly_activity":
            return analytics.monthly_activity(t("agg_activity_day_repo"))
        if name == "agg_language_usage":
            return analytics.language_usage(t("raw_languages"), t("fct_commits"), t("dim_repository"))
        if name == "agg_hourly_heatmap":
            return analytics.hourly_heatmap(self.spark, t("fct_commits"))
        raise KeyError(name)

    # ------------------------------------------------------------ written tables
    def table(self, name: str, partitioned: bool = False) -> DataFrame:
        """The written table.  Facts are stored by event month; the partition
        column is hidden unless ``partitioned=True``."""
        if not self.materialize:
            if name not in self._lazy:
                self._lazy[name] = self.build(name)
            return self._lazy[name]
        root = self.ensure(name)
        key = (self.spark._jsparkSession.sessionUUID(), f"{root}/{name}")
        df = _READ_CACHE.get(key)
        if df is None:
            # written folders are immutable (named by content), so one scan
            # object per folder is shared by all queries of the session
            df = _READ_CACHE[key] = self.spark.read.parquet(f"{root}/{name}")
        part = _PARTITION_COLUMN.get(name)
        return df if partitioned or part is None else df.drop(part)

    def raw(self, name: str) -> DataFrame:
        return self.table(name)

    def landed(self, name: str) -> DataFrame:
        """The rows that landed for a raw table, rejected ones too."""
        return fixtures.LANDED_BUILDERS[name](self.tables)

    def __getattr__(self, name: str) -> DataFrame:
        if name in LAYERS:
            return self.table(name)
        raise AttributeError(name)

    def _write(self, name: str, path: str) -> None:
        df = self.build(name)
        if name in RAW:
            # Rows sorted by ingestion time inside each file: the pushed
            # high-water filter skips row groups by their min/max statistics.
            # (Production raw tables are day-partitioned by ``append_raw``;
            # the derived fixture spreads few rows over thousands of
            # "ingestion days", which would only make tiny files here.)
            _writer(df.sortWithinPartitions("ingestion_timestamp")).parquet(path)
        elif name in FACT_EVENT_TS:
            out = merge.for_month_write(merge.with_event_month(df, FACT_EVENT_TS[name]), FACT_KEY[name])
            _writer(out).partitionBy(merge.EVENT_MONTH).parquet(path)
        else:
            _writer(df).parquet(path)

    def ensure_materialized(self) -> str:
        """Write every table that is not there yet and return the folder."""
        return self.ensure(*LAYERS)

    def ensure(self, *names: str) -> str:
        """Write the tables ``names`` and those they are computed from, as far
        as they are not there yet, and return the folder of all tables."""
        if self._root is None:
            self._root = f"{_base_dir(self.spark)}/{_fingerprint(self.spark, self.sf_dir, self.dim_end)}"
        if not self._ready.issuperset(names):       # builders find what they read in ``_ready``
            with _lock:
                missing = self._missing(names)
                if missing:
                    self._build_missing(missing)
                self._ready.update(names)
        return self._root

    def _written(self, name: str) -> bool:
        if name not in self._ready and sinks.exists(self.spark, f"{self._root}/{name}/_COMPLETE"):
            self._ready.add(name)
        return name in self._ready

    def _missing(self, names) -> set[str]:
        out: set[str] = set()
        todo = list(names)
        while todo:
            name = todo.pop()
            if name not in out and not self._written(name):
                out.add(name)
                todo.extend(NEEDS.get(name, ()))
        return out

    def _build_missing(self, missing: set[str]) -> None:
        tmp = f"{_base_dir(self.spark)}/_building-{uuid.uuid4().hex}"
        try:
            with shuffles_dropped(self.spark), ThreadPoolExecutor(max_workers=6) as pool:
                for wave in WAVES:
                    todo = [name for name in wave if name in missing]
                    jobs = [pool.submit(self._write, name, f"{tmp}/{name}") for name in todo]
                    for j in jobs:
                        j.result()
                    for name in todo:
                        self._publish(name, f"{tmp}/{name}")
        finally:
            sinks.delete(self.spark, tmp)   # a half-written table is never published

    def _publish(self, name: str, written: str) -> None:
        path = f"{self._root}/{name}"
        fs, dst = sinks._fs(self.spark, path)
        fs.mkdirs(dst.getParent())
        # if it exists, another writer published the same content first
        if not fs.exists(dst) and not fs.rename(sinks._fs(self.spark, written)[1], dst):
            raise OSError(f"could not publish {written} as {path}")
        fs.create(sinks._fs(self.spark, f"{path}/_COMPLETE")[1], True).close()
        self._ready.add(name)
