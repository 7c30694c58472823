"""Aggregate tables (AGG-01..08).

Shape rules used throughout: aggregate before joining (partial
aggregation runs map-side, so a hot key costs one row per map task),
broadcast only relations whose size is bounded by a parameter (the 168
heatmap cells, the top-N languages), and never build all pairs of two
growing inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalar import month_start, surrogate_key, week_start
from ..operators.dedup import latest_per_key, tie_breaks_for


def activity_rows(fct_commits: DataFrame, fct_prs: DataFrame) -> DataFrame:
    """One row per commit and per created PR: date, repo, kind flags, lines."""
    c = fct_commits.select(F.to_date("committed_at").alias("activity_date"), "repo_id",
                           F.lit(1).alias("is_commit"), F.lit(0).alias("is_pr"),
                           F.col("total_changes").alias("lines"))
    p = fct_prs.select(F.to_date("created_at").alias("activity_date"), "repo_id",
                       F.lit(0).alias("is_commit"), F.lit(1).alias("is_pr"),
                       F.lit(0).cast("bigint").alias("lines"))
    return c.unionByName(p).filter(F.col("activity_date").isNotNull())


def activity_by_day_repo(fct_commits: DataFrame, fct_prs: DataFrame) -> DataFrame:
    """The finest activity grain, built once: one row per (date, repo) with
    commits, PRs created and lines changed.  Daily, weekly and monthly
    tables roll up from it; distinct repositories stay exact because the
    repository is still a column here."""
    return activity_rows(fct_commits, fct_prs).groupBy("activity_date", "repo_id").agg(
        F.sum("is_commit").alias("commits"),
        F.sum("is_pr").alias("prs_created"),
        F.sum("lines").alias("lines_changed"))


def _activity_by(day_repo: DataFrame, period: str) -> DataFrame:
    return day_repo.groupBy(period).agg(
        F.sum("commits").alias("commits"),
        F.sum("prs_created").alias("prs_created"),
        F.sum("lines_changed").alias("lines_changed"),
        F.countDistinct("repo_id").alias("active_repos"),
    )


def daily_activity(day_repo: DataFrame) -> DataFrame:
    """AGG-01: per date; days without activity are absent."""
    return _activity_by(day_repo, "activity_date")


def weekly_activity(day_repo: DataFrame) -> DataFrame:
    """AGG-02: per ISO week (Monday start), distincts recomputed per week,
    plus the change in commits versus the previous week that has data.

    The ``lag`` window has no partition key: it runs over one row per
    week, a size bounded by the calendar, not by data volume."""
    g = _activity_by(day_repo.withColumn("week_start", week_start("activity_date")), "week_start")
    w = Window.orderBy("week_start")
    return g.withColumn("commits_change", F.col("commits") - F.lag("commits").over(w))


def monthly_activity(day_repo: DataFrame) -> DataFrame:
    """AGG-03: per calendar month."""
    return _activity_by(day_repo.withColumn("month_start", month_start("activity_date")), "month_start")


def language_bytes_by_month(raw_languages: DataFrame) -> DataFrame:
    """Bytes and repositories per (month, language) from the last snapshot of
    each (repo, language) inside the month: one row a repository, so counting
    rows (that name one) counts distinct repositories."""
    m = raw_languages.withColumn("month_start", month_start("ingestion_timestamp"))
    keys = ["month_start", "repo_full_name", "language_name"]
    last = latest_per_key(m, keys, tie_breaks=tie_breaks_for(m, keys))
    return last.groupBy("month_start", "language_name").agg(
        F.sum("byte_count").alias("bytes"),
        F.count("repo_full_name").alias("repo_count"),
    )


def language_usage(raw_languages: DataFrame, fct_commits: DataFrame, dim_repo: DataFrame) -> DataFrame:
    """AGG-04: per (month, language): bytes and repositories from language
    snapshots, commits in repositories whose primary language it is.
    Both sides are aggregated before the (full outer) join."""
    per_repo = (fct_commits.select("repo_id", month_start("committed_at").alias("month_start"))
                .filter(F.col("month_start").isNotNull())
                .groupBy("repo_id", "month_start").agg(F.count(F.lit(1)).alias("n")))
    return language_usage_from(language_bytes_by_month(raw_languages), per_repo, dim_repo)


def commits_by_month_repo(day_repo: DataFrame) -> DataFrame:
    """Commits per (repo, month), rolled up from the day-by-repository table."""
    return (day_repo.withColumn("month_start", month_start("activity_date"))
            .groupBy("repo_id", "month_start").agg(F.sum("commits").alias("n")).filter(F.col("n") > 0))


def language_usage_from(b: DataFrame, per_repo: DataFrame, dim_repo: DataFrame) -> DataFrame:
    """AGG-04 from bytes by (month, language) and commits by (repo, month)."""
    langs = dim_repo.select("repo_id", F.col("primary_language").alias("language_name"))
    c = (per_repo.join(langs, "repo_id", "inner").filter(F.col("language_name").isNotNull())
         .groupBy("month_start", "language_name").agg(F.sum("n").alias("commit_count")))
    j = b.join(c, ["month_start", "language_name"], "full")
    return j.select("month_start", "language_name",
                    F.coalesce("bytes", F.lit(0)).alias("bytes"),
                    F.coalesce("repo_count", F.lit(0)).alias("repo_count"),
                    F.coalesce("commit_count", F.lit(0)).alias("commit_count"))


def hour_grid(spark: SparkSession) -> DataFrame:
    """The 7 x 24 (day_of_week, hour) cells; fixed size, generated, not a cross join."""
    return spark.range(168).select((F.floor(F.col("id") / 24) + 1).alias("day_of_week"),
                                   (F.col("id") % 24).alias("hour_of_day"))


def hourly_heatmap(spark: SparkSession, fct_commits: DataFrame) -> DataFrame:
    """AGG-05 / DSH-02: commits per (day_of_week, hour_of_day), all 168 cells."""
    return heatmap_from(spark, hour_counts(fct_commits))


def hour_counts(fct_commits: DataFrame, *by: str) -> DataFrame:
    """Commits per (day_of_week, hour_of_day) and the columns ``by``."""
    return fct_commits.groupBy(*by, "day_of_week", "hour_of_day").agg(F.count(F.lit(1)).alias("commits"))


def heatmap_from(spark: SparkSession, hours: DataFrame) -> DataFrame:
    """AGG-05 from ``hour_counts``."""
    counts = hours.groupBy("day_of_week", "hour_of_day").agg(F.sum("commits").alias("commits"))
    g = F.broadcast(hour_grid(spark))
    j = g.join(counts, ["day_of_week", "hour_of_day"], "left")
    return j.select("day_of_week", "hour_of_day", F.coalesce("commits", F.lit(0)).alias("commits"))


def dim_language(stg_languages: DataFrame, stg_repositories: DataFrame) -> DataFrame:
    """AGG-06: distinct language names (from language snapshots and
    repository primary languages) with a hash key."""
    names = (stg_languages.select(F.col("language_name").alias("n"))
             .unionByName(stg_repositories.select(F.col("primary_language").alias("n")))
             .filter(F.col("n").isNotNull()).distinct())
    return names.select(surrogate_key("n").alias("language_id"), F.col("n").alias("language_name"))


TOP_LANGUAGES = 5


def languages_pivot(stg_languages: DataFrame, top_n: int = TOP_LANGUAGES) -> DataFrame:
    """AGG-07: per repository, bytes of each of the ``top_n`` languages with
    most bytes overall (ties by name); column ``top{k}_bytes`` is the k-th,
    ``other_bytes`` holds all further languages, so no repository and no byte
    is left out.

    The pivot values are the ranks 1..top_n, known before the query, so no
    driver round trip is needed; the ranked list has ``top_n`` rows and is
    broadcast."""
    totals = stg_languages.groupBy("language_name").agg(F.sum("byte_count").alias("total"))
    top = totals.orderBy(F.col("total").desc(), F.col("language_name").asc()).limit(top_n)
    ranked = top.withColumn("rk", F.row_number().over(
        Window.orderBy(F.col("total").desc(), F.col("language_name").asc()))).select("language_name", "rk")
    j = stg_languages.select("repo_full_name", "language_name", "byte_count") \
        .join(F.broadcast(ranked), "language_name", "left")
    # pivot on the rank by conditional sums: one shuffle with partial aggregation
    return j.groupBy("repo_full_name").agg(*[
        F.sum(F.when(F.col("rk") == k, F.col("byte_count"))).alias(f"top{k}_bytes") for k in range(1, top_n + 1)],
        F.sum(F.when(F.col("rk").isNull(), F.col("byte_count"))).alias("other_bytes"))


def review_counts(fct_prs: DataFrame, fct_reviews: DataFrame) -> DataFrame:
    """AGG-08: reviews per pr_key, 0 when a PR has none."""
    n = fct_reviews.filter(F.col("pr_key").isNotNull()).groupBy("pr_key").agg(F.count(F.lit(1)).alias("n"))
    return fct_prs.select("pr_key").join(n, "pr_key", "left") \
        .select("pr_key", F.coalesce("n", F.lit(0)).alias("review_count"))
