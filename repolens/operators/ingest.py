"""Raw load: flatten landed JSON rows, stamp the batch, split on REQUIRED
columns, and count what was loaded.

All functions are narrow (per-row) projections: no shuffle.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import utc_wallclock
from ..schemas import LANDED_AT, RAW_SCHEMAS, REQUIRED


def _num_or_zero(parent: str, leaf: str) -> Column:
    """A number inside a JSON object: 0 when the object is present but the
    field is missing (the source decodes into primitives), NULL when the
    whole object is absent."""
    return F.when(F.col(parent).isNotNull(), F.coalesce(F.col(f"{parent}.{leaf}").cast("bigint"), F.lit(0)))


def _conform(df: DataFrame, table: str) -> DataFrame:
    """Order and type columns exactly as the raw table declares; what the
    landing reader added (``CARRIED``) goes along behind them."""
    sch = RAW_SCHEMAS[table]
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in sch.fields], *_carried(df))


CARRIED = (LANDED_AT, "_file")


def _carried(df: DataFrame) -> list[str]:
    return [c for c in CARRIED if c in df.columns]


def to_raw_commits(df: DataFrame, repo: str | Column | None = None) -> DataFrame:
    """ING-01.  ``changed_files`` is ``stats.total`` (additions + deletions),
    kept from the source mapping although the name suggests a file count."""
    repo_col = _repo(df, repo)
    return _conform(df.select(
        F.col("sha"),
        repo_col.alias("repo_full_name"),
        F.col("commit.author.name").alias("author_name"),
        F.col("commit.author.email").alias("author_email"),
        utc_wallclock(F.col("commit.author.date")).alias("author_date"),
        F.col("commit.message").alias("message"),
        _num_or_zero("stats", "additions").alias("additions"),
        _num_or_zero("stats", "deletions").alias("deletions"),
        _num_or_zero("stats", "total").alias("changed_files"),
        F.lit(None).alias("ingestion_timestamp"), *_carried(df),
    ), "raw_commits")


def to_raw_pull_requests(df: DataFrame, repo: str | Column | None = None) -> DataFrame:
    """ING-02.  A missing ``number`` decodes to 0 (primitive field)."""
    return _conform(df.select(
        F.coalesce(F.col("number").cast("bigint"), F.lit(0)).alias("number"),
        _repo(df, repo).alias("repo_full_name"),
        "title", "state",
        F.col("user.login").alias("user_login"),
        utc_wallclock("created_at").alias("created_at"),
        utc_wallclock("updated_at").alias("updated_at"),
        utc_wallclock("merged_at").alias("merged_at"),
        "merge_commit_sha",
        F.lit(None).alias("ingestion_timestamp"), *_carried(df),
    ), "raw_pull_requests")


def to_raw_reviews(df: DataFrame, repo: str | Column | None = None, pr_number=None) -> DataFrame:
    """ING-03.  ``pr_number`` comes from the request (path column), not the payload."""
    pr = F.col("pr_number") if pr_number is None else (pr_number if isinstance(pr_number, Column) else F.lit(pr_number))
    return _conform(df.select(
        F.coalesce(F.col("id"), F.lit(0)).alias("id"),
        _repo(df, repo).alias("repo_full_name"),
        pr.cast("bigint").alias("pr_number"),
        F.col("user.login").alias("user_login"),
        "state",
        utc_wallclock("submitted_at").alias("submitted_at"),
        "body",
        F.lit(None).alias("ingestion_timestamp"), *_carried(df),
    ), "raw_reviews")


def to_raw_repositories(df: DataFrame) -> DataFrame:
    """ING-04.  Missing numbers/booleans decode to 0/false."""
    return _conform(df.select(
        F.coalesce(F.col("id"), F.lit(0)).alias("id"),
        "name", "full_name",
        F.col("owner.login").alias("owner_login"),
        "language",
        utc_wallclock("created_at").alias("created_at"),
        utc_wallclock("updated_at").alias("updated_at"),
        "visibility",
        F.coalesce(F.col("fork"), F.lit(False)).alias("fork"),
        F.coalesce(F.col("stargazers_count"), F.lit(0)).alias("stargazers_count"),
        F.lit(None).alias("ingestion_timestamp"), *_carried(df),
    ), "raw_repositories")


def to_raw_languages(df: DataFrame, repo: str | Column | None = None, map_col: str = "languages") -> DataFrame:
    """ING-05.  One row per (repo, language); a NULL or empty map gives no
    rows (``explode``, not ``explode_outer``)."""
    e = df.select(_repo(df, repo).alias("repo_full_name"),
                  F.explode(F.col(map_col)).alias("language_name", "byte_count"), *_carried(df))
    return _conform(e.withColumn("ingestion_timestamp", F.lit(None)), "raw_languages")


def _repo(df: DataFrame, repo) -> Column:
    if repo is None:
        return F.col("repo_full_name")
    return repo if isinstance(repo, Column) else F.lit(repo)


def stamp(df: DataFrame, batch_ts: _dt.datetime | str) -> DataFrame:
    """ING-06: one ingestion timestamp for the whole batch, overwriting any given value."""
    ts = batch_ts.strftime("%Y-%m-%d %H:%M:%S.%f") if isinstance(batch_ts, _dt.datetime) else batch_ts
    return df.withColumn("ingestion_timestamp", F.lit(ts).cast("timestamp_ntz"))


def rejection_reasons(required: list[str]) -> Column:
    """Array of 'required field <c> is null' for each violated column (empty when valid)."""
    return F.array_compact(F.array(*[
        F.when(F.col(c).isNull(), F.lit(f"required field {c} is null")) for c in required]))


def split_valid(df: DataFrame, table: str | None = None, required: list[str] | None = None
                ) -> tuple[DataFrame, DataFrame]:
    """ING-07: (accepted rows, rejected rows with an ``errors`` array).

    Spark does not enforce ``nullable=False`` when reading files, so the
    REQUIRED mode of the raw schema is applied here explicitly.
    """
    req = required if required is not None else REQUIRED[table]
    tagged = df.withColumn("_errors", rejection_reasons(req))
    ok = tagged.filter(F.size("_errors") == 0).drop("_errors")
    bad = tagged.filter(F.size("_errors") > 0).withColumnRenamed("_errors", "errors")
    return ok, bad


def load_metrics(df: DataFrame, table: str | None = None, required: list[str] | None = None,
                 by: list[str] | None = None) -> DataFrame:
    """ING-08 as one aggregation: total rows, successful rows (total minus
    distinct failing rows), failing rows and the number of errors (one per
    violated column).  Empty input gives one row of zeros (no grouping)."""
    req = required if required is not None else REQUIRED[table]
    n_err = F.size(rejection_reasons(req))
    g = df.groupBy(*(by or []))
    return g.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(n_err == 0).alias("successful_rows"),
        F.count_if(n_err > 0).alias("failed_rows"),
        F.coalesce(F.sum(n_err), F.lit(0)).cast("bigint").alias("error_count"),
    )
