"""Mart models: date and repository dimensions, three fact tables.

Facts left-join the dimensions as of load time.  ``dim_date`` is broadcast
explicitly: its size is fixed by the date range parameters (2,922 rows for
2020-2027), never by data volume.  ``dim_repository`` grows with the
number of repositories, so the join strategy is left to AQE, which
broadcasts it only when its runtime size is under
``spark.sql.autoBroadcastJoinThreshold`` and otherwise sort-merge joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import date_key, day_of_week, iso_week, left_chars, part, surrogate_key
from ..sources.calendar import DEFAULT_START, date_spine


def dim_date(spark: SparkSession, start=DEFAULT_START, end=None) -> DataFrame:
    d = F.col("date_day")
    dow = day_of_week(d)
    return date_spine(spark, start, end).select(
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        dow.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        part(F.dayofmonth, d).alias("day_of_month"),
        iso_week(d).alias("iso_week_number"),
        part(F.month, d).alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        part(F.quarter, d).alias("quarter"),
        part(F.year, d).alias("year"),
        dow.isin(1, 7).alias("is_weekend"),
    )


def dim_repository(stg_repositories: DataFrame) -> DataFrame:
    return stg_repositories.select(
        surrogate_key("full_name").alias("repo_id"),
        F.col("repository_name").alias("repo_name"),
        F.col("full_name").alias("repo_full_name"),
        "owner", "primary_language", "created_at", "visibility", "is_fork", "stargazers_count",
    )


def _date_keys(dim: DataFrame, prefix: str) -> DataFrame:
    return F.broadcast(dim.select(F.col("full_date").alias(f"{prefix}_full_date"),
                                  F.col("date_key").alias(f"{prefix}_date_key")))


def _repo_keys(dim_repo: DataFrame) -> DataFrame:
    return dim_repo.select(F.col("repo_full_name").alias("_repo_name"), "repo_id")


def fct_commits(stg: DataFrame, dim_repo: DataFrame, dim_dt: DataFrame) -> DataFrame:
    r = _repo_keys(dim_repo)
    d = _date_keys(dim_dt, "c")
    # only the part of the message that the fact keeps goes through the join
    c = stg.withColumn("commit_message", left_chars("commit_message", 100))
    j = (c.join(r, c.repo_full_name == r._repo_name, "left")
          .join(d, F.to_date(c.authored_at) == F.col("c_full_date"), "left"))
    return j.select(
        "commit_sha", "repo_id",
        F.col("c_date_key").alias("date_key"),
        F.col("authored_at").alias("committed_at"),
        "hour_of_day", "day_of_week", "author_name", "author_email",
        F.col("commit_message").alias("message_first_line"),
        F.col("lines_added").alias("additions"),
        F.col("lines_deleted").alias("deletions"),
        F.col("files_changed").alias("changed_files"),
        (F.coalesce("lines_added", F.lit(0)) + F.coalesce("lines_deleted", F.lit(0))).alias("total_changes"),
        "ingestion_timestamp",
    )


def pr_key(repo_col, number_col):
    return F.concat(F.col(repo_col), F.lit("#"), F.col(number_col).cast("string"))


def fct_pull_requests(stg: DataFrame, dim_repo: DataFrame, dim_dt: DataFrame) -> DataFrame:
    r = _repo_keys(dim_repo)
    dc, dm = _date_keys(dim_dt, "cr"), _date_keys(dim_dt, "mg")
    j = (stg.join(r, stg.repo_full_name == r._repo_name, "left")
            .join(dc, F.to_date(stg.created_at) == F.col("cr_full_date"), "left")
            .join(dm, F.to_date(stg.merged_at) == F.col("mg_full_date"), "left"))
    return j.select(
        pr_key("repo_full_name", "pr_number").alias("pr_key"),
        "repo_id", "pr_number",
        F.col("pr_title").alias("title"),
        "state", "is_merged", "created_at",
        F.col("cr_date_key").alias("created_date_key"),
        "merged_at",
        F.col("mg_date_key").alias("merged_date_key"),
        "time_to_merge_hours",
        F.col("author_login").alias("user_login"),
        "ingestion_timestamp",
    )


def fct_reviews(stg: DataFrame, dim_repo: DataFrame, dim_dt: DataFrame, fct_prs: DataFrame) -> DataFrame:
    """Reviews joined to the PR fact on the composed key.  The PR side is
    projected to its key only; both sides grow with data, so this is a
    shuffle join (AQE splits a skewed PR key on the review side)."""
    r = _repo_keys(dim_repo)
    d = _date_keys(dim_dt, "s")
    prs = fct_prs.select(F.col("pr_key").alias("_pr_key"))
    # the key is composed after the first join, so only its parts go through it
    rv = (stg.join(r, stg.repo_full_name == r._repo_name, "left")
             .withColumn("_rv_key", pr_key("repo_full_name", "pr_number")))
    j = (rv.join(prs, F.col("_rv_key") == F.col("_pr_key"), "left")
           .join(d, F.to_date(rv.submitted_at) == F.col("s_full_date"), "left"))
    return j.select(
        "review_id", "repo_id",
        F.col("_pr_key").alias("pr_key"),
        "reviewer_login", "review_state", "submitted_at",
        F.col("s_date_key").alias("date_key"),
        "ingestion_timestamp",
    )
