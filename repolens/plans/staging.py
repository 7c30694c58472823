"""Staging models: latest snapshot per key, typed and renamed.

Every function takes the raw DataFrame and an optional high-water mark
``since``.  With ``since`` the strict filter ``ingestion_timestamp >
since`` is applied *below* the de-duplication (and on the day partition
column when the raw frame has it), which is equivalent for commits, pull
requests, reviews and repositories: a key's newest row is newer than the
mark exactly when some row is, and it is then also the newest of the
newer rows.  It is not applied to languages, whose share needs every
language of a repository.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import (day_of_week, iso_week, owner_of, part, safe_timestamp,
                                whole_hours)
from ..operators.dedup import latest_per_key, tie_breaks_for
from ..schemas import PARTITION_COLUMN

# Dedup keys per raw table.
KEYS = {
    "raw_commits": ["sha"],
    "raw_pull_requests": ["repo_full_name", "number"],
    "raw_reviews": ["id"],
    "raw_repositories": ["id"],
    "raw_languages": ["repo_full_name", "language_name"],
}


def newer_than(raw: DataFrame, since) -> DataFrame:
    """Strict high-water filter, also expressed on the day partition column
    (when present) so the scan prunes whole days."""
    if since is None:
        return raw
    lit_ts = F.lit(since).cast("timestamp_ntz") if not isinstance(since, _dt.datetime) \
        else F.lit(since.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    out = raw
    if PARTITION_COLUMN in raw.columns:
        out = out.filter(F.col(PARTITION_COLUMN) >= F.to_date(lit_ts))
    return out.filter(F.col("ingestion_timestamp") > lit_ts)


def _dedup(raw: DataFrame, table: str) -> DataFrame:
    raw = raw.drop(PARTITION_COLUMN) if PARTITION_COLUMN in raw.columns else raw
    keys = KEYS[table]
    return latest_per_key(raw, keys, tie_breaks=tie_breaks_for(raw, keys))


def stg_commits(raw: DataFrame, since=None) -> DataFrame:
    d = _dedup(newer_than(raw, since), "raw_commits")
    at = safe_timestamp("author_date")
    return d.select(
        F.col("sha").alias("commit_sha"),
        "repo_full_name", "author_name", "author_email",
        at.alias("authored_at"),
        F.col("message").alias("commit_message"),
        F.col("additions").cast("bigint").alias("lines_added"),
        F.col("deletions").cast("bigint").alias("lines_deleted"),
        F.col("changed_files").cast("bigint").alias("files_changed"),
        part(F.hour, at).alias("hour_of_day"),
        day_of_week(at).alias("day_of_week"),
        iso_week(at).alias("iso_week"),
        part(F.month, at).alias("month"),
        part(F.year, at).alias("year"),
        "ingestion_timestamp",
    )


def stg_pull_requests(raw: DataFrame, since=None) -> DataFrame:
    d = _dedup(newer_than(raw, since), "raw_pull_requests")
    merged = F.col("merged_at").isNotNull()
    created, merged_ts = safe_timestamp("created_at"), safe_timestamp("merged_at")
    return d.select(
        F.concat(F.col("repo_full_name"), F.lit("-"), F.col("number").cast("string")).alias("pr_id"),
        F.col("number").cast("bigint").alias("pr_number"),
        "repo_full_name",
        F.col("title").alias("pr_title"),
        F.when(merged, "merged").when(F.lower("state") == "closed", "closed").otherwise("open").alias("state"),
        F.col("user_login").alias("author_login"),
        created.alias("created_at"),
        safe_timestamp("updated_at").alias("updated_at"),
        merged_ts.alias("merged_at"),
        "merge_commit_sha",
        merged.alias("is_merged"),
        F.when(merged, whole_hours(created, merged_ts)).alias("time_to_merge_hours"),
        "ingestion_timestamp",
    )


def stg_reviews(raw: DataFrame, since=None) -> DataFrame:
    d = _dedup(newer_than(raw, since), "raw_reviews")
    return d.select(
        F.col("id").cast("bigint").alias("review_id"),
        "repo_full_name",
        F.col("pr_number").cast("bigint").alias("pr_number"),
        F.concat(F.col("repo_full_name"), F.lit("-"), F.col("pr_number").cast("string")).alias("pr_id"),
        F.col("user_login").alias("reviewer_login"),
        # The reference's simple CASE maps every known state to itself and
        # everything else to upper(state): it equals upper(state).
        F.upper("state").alias("review_state"),
        safe_timestamp("submitted_at").alias("submitted_at"),
        F.col("body").alias("review_body"),
        "ingestion_timestamp",
    )


def stg_repositories(raw: DataFrame, since=None) -> DataFrame:
    d = _dedup(newer_than(raw, since), "raw_repositories")
    return d.select(
        F.col("id").cast("bigint").alias("repository_id"),
        F.col("name").alias("repository_name"),
        "full_name",
        owner_of("full_name").alias("owner"),
        "owner_login",
        F.col("language").alias("primary_language"),
        safe_timestamp("created_at").alias("created_at"),
        safe_timestamp("updated_at").alias("updated_at"),
        "visibility",
        F.col("fork").alias("is_fork"),
        F.col("stargazers_count").cast("bigint").alias("stargazers_count"),
        "ingestion_timestamp",
    )


def stg_languages(raw: DataFrame) -> DataFrame:
    """Latest (repo, language) rows and each language's share of the repo's bytes.

    The share window is partitioned by repository over de-duplicated rows,
    so a partition holds at most one row per distinct language.
    """
    d = _dedup(raw, "raw_languages")
    b = F.col("byte_count").cast("bigint")
    total = F.sum(b).over(Window.partitionBy("repo_full_name"))
    return d.select(
        "repo_full_name", "language_name",
        b.alias("byte_count"),
        F.try_divide(b.cast("double"), total.cast("double")).alias("language_percentage"),
        "ingestion_timestamp",
    )


STAGING = {
    "stg_commits": ("raw_commits", stg_commits),
    "stg_pull_requests": ("raw_pull_requests", stg_pull_requests),
    "stg_reviews": ("raw_reviews", stg_reviews),
    "stg_repositories": ("raw_repositories", stg_repositories),
    "stg_languages": ("raw_languages", stg_languages),
}


def register_staging(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Publish the five staging relations as temp views (the reference's
    staging layer is made of views) and return them."""
    out = {}
    for name, (src, fn) in STAGING.items():
        df = fn(raw[src])
        df.createOrReplaceTempView(name)
        out[name] = df
    return out
