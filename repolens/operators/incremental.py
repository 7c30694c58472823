"""Incremental extraction state: per-entity watermarks, "newer than"
filters, review scoping and the watermark gate.

The watermark table is tiny (one row per entity).  It is stored as
immutable version folders ``v=<n>`` each finished by a ``_SUCCESS``
marker; readers take the newest complete version, writers add a new one.
A reader never sees a half-written table and no path is overwritten
while it is being read.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import utc_wallclock
from ..schemas import WATERMARK_SCHEMA, WATERMARK_TABLE
from . import sinks


def _wm_root(root: str) -> str:
    return f"{root.rstrip('/')}/raw/{WATERMARK_TABLE}"


def _versions(spark: SparkSession, root: str) -> list[int]:
    out = []
    for name in sinks.list_dirs(spark, _wm_root(root)):
        if name.startswith("v=") and name[2:].isdigit():
            if sinks.exists(spark, f"{_wm_root(root)}/{name}/_SUCCESS"):
                out.append(int(name[2:]))
    return sorted(out)


def read_watermarks(spark: SparkSession, root: str) -> DataFrame:
    """The newest complete version of the watermark table (empty if none)."""
    vs = _versions(spark, root)
    if not vs:
        return spark.createDataFrame([], WATERMARK_SCHEMA)
    return spark.read.schema(WATERMARK_SCHEMA).parquet(f"{_wm_root(root)}/v={vs[-1]}")


def get_watermark(spark: SparkSession, root: str, entity: str, strict: bool = False):
    """INC-01: last extraction instant of ``entity``; None when absent or
    unreadable, which makes the run fall back to a full extraction.
    ``strict`` raises what made it unreadable: a passing read error should
    not rebuild a whole fact."""
    try:
        r = read_watermarks(spark, root).filter(F.col("entity_type") == entity) \
            .agg(F.max("last_extracted_at").alias("m")).first()
        return None if r is None else r["m"]
    except Exception:  # unreadable state -> full extraction
        if strict:
            raise
        return None


def set_watermarks(spark: SparkSession, root: str, marks: dict[str, _dt.datetime],
                   now: _dt.datetime | None = None) -> int:
    """INC-02: upsert (entity -> instant); ``updated_at`` = now.  Writes a
    new version and returns its number; write errors propagate."""
    if not marks:
        return -1
    now = now or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    cur = read_watermarks(spark, root)
    new = spark.createDataFrame([(e, ts, now) for e, ts in sorted(marks.items())], WATERMARK_SCHEMA)
    merged = cur.join(new.select("entity_type"), "entity_type", "left_anti").unionByName(new)
    vs = _versions(spark, root)
    v = (vs[-1] + 1) if vs else 0
    merged.coalesce(1).write.mode("errorifexists").parquet(f"{_wm_root(root)}/v={v}")
    return v


def set_watermark(spark: SparkSession, root: str, entity: str, ts: _dt.datetime,
                  now: _dt.datetime | None = None) -> int:
    return set_watermarks(spark, root, {entity: ts}, now)


def since_commits(df: DataFrame, since, date_col: str = "author_date") -> DataFrame:
    """INC-03: commits whose author date is after the watermark (unknown dates kept)."""
    if since is None:
        return df
    return df.filter(_keep_after(df, date_col, since))


def since_pull_requests(df: DataFrame, since, date_col: str = "updated_at") -> DataFrame:
    """INC-04: pull requests updated after the watermark (unknown dates kept)."""
    if since is None:
        return df
    return df.filter(_keep_after(df, date_col, since))


def _keep_after(df: DataFrame, col: str, since) -> Column:
    # landed JSON carries ISO-8601 text with an offset; raw tables carry timestamp_ntz
    is_text = dict(df.dtypes)[col] == "string"
    t = utc_wallclock(col) if is_text else F.col(col).try_cast("timestamp_ntz")
    mark = F.lit(since.strftime("%Y-%m-%d %H:%M:%S.%f") if isinstance(since, _dt.datetime) else str(since)) \
        .cast("timestamp_ntz")
    return t.isNull() | (t > mark)


def reviews_in_scope(reviews: DataFrame, prs: DataFrame, review_number: str = "pr_number",
                     pr_number: str = "number") -> DataFrame:
    """INC-05: reviews of the pull requests that passed INC-04 (left semi
    join on repository and PR number; the per-PR fetch loop of the source
    becomes one shuffle join)."""
    keys = prs.select(F.col("repo_full_name").alias("_r"), F.col(pr_number).alias("_n"))
    cond = (reviews.repo_full_name == keys._r) & (reviews[review_number] == keys._n)
    return reviews.join(keys, cond, "left_semi")


def advanceable_entities(results: DataFrame) -> DataFrame:
    """INC-07: per entity, whether its watermark may advance: at least one
    successful step and no failed one."""
    return results.groupBy("entityType").agg(
        F.bool_or("success").alias("any_success"),
        F.bool_and("success").alias("all_success"),
    ).withColumn("advance", F.col("any_success") & F.col("all_success"))
