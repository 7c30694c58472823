"""Dashboard queries (the reference specifies them in one line each; the
exact definitions are ours and documented in the README)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import month_start, week_start, whole_hours


def merge_rate(fct_prs: DataFrame, dim_repo: DataFrame) -> DataFrame:
    """Merged / all PRs per repository plus an overall row (``is_total``).

    The fact is first reduced to one row per repo_id (partial aggregation
    before the shuffle, so a hot repository costs one row per map task);
    only that small result is joined to the dimension and rolled up.
    """
    per_repo = fct_prs.groupBy("repo_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("is_merged").cast("bigint")).alias("m"))
    r = dim_repo.select("repo_id", "repo_full_name")
    j = per_repo.join(r, "repo_id", "left")
    g = j.rollup("repo_full_name").agg(
        (F.grouping("repo_full_name") == 1).alias("is_total"),
        F.sum("n").alias("pr_count"),
        F.sum("m").alias("merged_count"),
    )
    return g.withColumn("merge_rate", F.col("merged_count").cast("double") / F.col("pr_count"))


def _commit_days(fct_commits: DataFrame) -> DataFrame:
    return (fct_commits.select(F.to_date("committed_at").alias("d")).filter(F.col("d").isNotNull())
            .groupBy("d").agg(F.count(F.lit(1)).alias("commits")))


def commit_trend(daily_activity: DataFrame) -> DataFrame:
    """DSH-01: commits per day, ISO week and month (``grain`` column), read
    from the AGG-01 table (one row per day); weeks and months are sums of
    the day counts."""
    day = daily_activity.filter(F.col("commits") > 0).select(F.col("activity_date").alias("d"), "commits")
    d = day.select(F.lit("day").alias("grain"), F.col("d").alias("period_start"), "commits")
    wk = day.groupBy(week_start("d").alias("period_start")).agg(F.sum("commits").alias("commits")) \
        .select(F.lit("week").alias("grain"), "period_start", "commits")
    mo = day.groupBy(month_start("d").alias("period_start")).agg(F.sum("commits").alias("commits")) \
        .select(F.lit("month").alias("grain"), "period_start", "commits")
    return d.unionByName(wk).unionByName(mo)


def streaks(fct_commits: DataFrame, as_of) -> DataFrame:
    """DSH-03: per author, the longest run of consecutive commit days and
    the current run (the run ending on ``as_of`` or the day before, else 0).

    Gaps and islands: ``day - row_number()`` is constant inside a run.  The
    window is partitioned by author over distinct (author, day) pairs, so
    a partition holds at most one row per calendar day."""
    as_of_d = F.lit(str(as_of)).cast("date")
    days = (fct_commits.select("author_name", F.to_date("committed_at").alias("d"))
            .filter(F.col("author_name").isNotNull() & F.col("d").isNotNull() & (F.col("d") <= as_of_d))
            .distinct())
    w = Window.partitionBy("author_name").orderBy("d")
    isl = days.withColumn("grp", F.date_sub("d", F.row_number().over(w)))
    runs = isl.groupBy("author_name", "grp").agg(F.count(F.lit(1)).alias("n"), F.max("d").alias("end_d"))
    cur = F.when(F.col("end_d") >= F.date_sub(as_of_d, 1), F.col("n"))
    return runs.groupBy("author_name").agg(
        F.max("n").alias("longest_streak"),
        F.coalesce(F.max(cur), F.lit(0)).alias("current_streak"))


ROLLING_DAYS = 30


def rolling_average(fct_commits: DataFrame) -> DataFrame:
    """DSH-04: commits per calendar day between the first and last commit
    day (days without commits are 0) and the trailing 30-day average.

    The spine comes from the data's own min/max day (one row, exploded);
    it and the window are bounded by the calendar span, not data volume."""
    day = _commit_days(fct_commits)
    span = day.agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
    spine = span.select(F.explode(F.sequence("lo", "hi")).alias("d"))
    dense = spine.join(day, "d", "left").select("d", F.coalesce("commits", F.lit(0)).alias("commits"))
    w = Window.orderBy("d").rowsBetween(-(ROLLING_DAYS - 1), 0)
    return dense.select(F.col("d").alias("activity_date"), "commits",
                        (F.sum("commits").over(w).cast("double") / ROLLING_DAYS).alias("rolling_avg_30d"))


def rolling_average_by_author(fct_commits: DataFrame) -> DataFrame:
    """DSH-04 per author: commits of every calendar day between the first and
    the last commit day of all authors, and the trailing 30-day average.

    The sum of the last 30 days changes only where commits enter it (+n on
    their day) or leave it (-n 30 days on), so the window runs over these
    changes, at most two an active day and author.  Each stretch of days with
    one sum is then spelt out; no table of all authors and days is shuffled or
    sorted."""
    ad = (fct_commits.select("author_name", F.to_date("committed_at").alias("d"))
          .filter(F.col("author_name").isNotNull() & F.col("d").isNotNull())
          .groupBy("author_name", "d").agg(F.count(F.lit(1)).alias("n")))
    days = _commit_days(fct_commits)
    lo, hi = (days.select(f("d")).scalar() for f in (F.min, F.max))
    events = F.array(F.struct(F.col("d"), F.col("n"), F.col("n").alias("change")),
                     F.struct(F.date_add("d", ROLLING_DAYS).alias("d"), F.lit(0).cast("bigint").alias("n"), (-F.col("n")).alias("change")),
                     F.struct(lo.alias("d"), F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("change")))
    changes = (ad.select("author_name", F.explode(events).alias("e")).select("author_name", "e.*").filter(F.col("d") <= hi)
               .groupBy("author_name", "d").agg(F.sum("n").alias("n"), F.sum("change").alias("change")))
    w = Window.partitionBy("author_name").orderBy("d")
    stretch = changes.select(
        "author_name", "d", "n", F.sum("change").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("total"),
        F.coalesce(F.date_sub(F.lead("d").over(w), 1), hi).alias("last"))
    each = stretch.select("author_name", "d", "n", "total", F.explode(F.sequence("d", "last")).alias("activity_date"))
    return each.select("author_name", "activity_date",
                       F.when(F.col("activity_date") == F.col("d"), F.col("n")).otherwise(F.lit(0)).alias("commits"),
                       (F.col("total").cast("double") / ROLLING_DAYS).alias("rolling_avg_30d"))


def language_share(stg_languages: DataFrame) -> DataFrame:
    """DSH-05: bytes per language and its share of all bytes (the total is
    a scalar subquery, no cross join)."""
    total = stg_languages.select(F.sum("byte_count")).scalar()
    g = stg_languages.groupBy("language_name").agg(F.sum("byte_count").alias("bytes"))
    return g.withColumn("share", F.col("bytes").cast("double") / total.cast("double"))


def language_trend(language_usage: DataFrame) -> DataFrame:
    """DSH-06: monthly bytes per language and share of the month, read from
    the AGG-04 table (rows with language snapshots, i.e. ``repo_count > 0``)."""
    b = language_usage.filter(F.col("repo_count") > 0).select("month_start", "language_name", "bytes")
    tot = F.sum("bytes").over(Window.partitionBy("month_start"))
    return b.select("month_start", "language_name", "bytes",
                    (F.col("bytes").cast("double") / tot.cast("double")).alias("share_of_month"))


TOP_REPOS = 3


def top_repositories_per_language(stg_languages: DataFrame, n: int = TOP_REPOS) -> DataFrame:
    """DSH-07: top-n repositories by bytes per language, ties by name.
    ``row_number() <= n`` becomes a partial WindowGroupLimit before the
    shuffle, so a language with a third of all rows is cut map-side."""
    w = Window.partitionBy("language_name").orderBy(F.col("byte_count").desc(), F.col("repo_full_name").asc())
    r = stg_languages.select("language_name", "repo_full_name", "byte_count") \
        .withColumn("rank", F.row_number().over(w).cast("bigint"))
    return r.filter(F.col("rank") <= n)


MERGE_BUCKETS = ((1, "0-1h"), (4, "1-4h"), (24, "4-24h"), (72, "24-72h"))


def merge_time_buckets(fct_prs: DataFrame) -> DataFrame:
    """DSH-08: merged PRs per open-to-merge bucket."""
    h = F.col("time_to_merge_hours")
    b = F.lit("72h+")
    for hi, label in reversed(MERGE_BUCKETS):
        b = F.when(h < hi, F.lit(label)).otherwise(b)
    return (fct_prs.filter(F.col("is_merged") & h.isNotNull())
            .groupBy(b.alias("bucket")).agg(F.count(F.lit(1)).alias("pr_count")))


def merge_time_percentiles(fct_prs: DataFrame) -> DataFrame:
    """DSH-08: exact p50 and p90 of hours to merge.  ``percentile`` keeps
    a value -> count map, bounded by the number of distinct whole hours."""
    h = F.col("time_to_merge_hours")
    m = fct_prs.filter(F.col("is_merged") & h.isNotNull())
    return m.agg(F.count(F.lit(1)).alias("merged_prs"),
                 F.round(F.percentile(h, F.lit(0.5)), 6).alias("p50_hours"),
                 F.round(F.percentile(h, F.lit(0.9)), 6).alias("p90_hours"))


def review_turnaround(fct_prs: DataFrame, fct_reviews: DataFrame) -> DataFrame:
    """DSH-09: hours from PR creation to its first review, mean and median
    per month of creation.  Reviews are reduced to one row per PR before
    the join."""
    first = (fct_reviews.filter(F.col("pr_key").isNotNull()).groupBy("pr_key")
             .agg(F.min("submitted_at").alias("first_review_at")))
    j = fct_prs.select("pr_key", "created_at").join(first, "pr_key", "inner")
    j = j.select(month_start("created_at").alias("month_start"),
                 whole_hours("created_at", "first_review_at").alias("h")).filter(F.col("h").isNotNull())
    return j.groupBy("month_start").agg(
        F.count(F.lit(1)).alias("pr_count"),
        (F.sum("h").cast("double") / F.count(F.lit(1))).alias("mean_hours"),
        F.round(F.percentile("h", F.lit(0.5)), 6).alias("median_hours"))


def _by_repo_name(per_repo: DataFrame, dim_repo: DataFrame) -> DataFrame:
    return per_repo.join(dim_repo.select("repo_id", "repo_full_name"), "repo_id", "left")


def pr_volume_by_repo(fct_prs: DataFrame, dim_repo: DataFrame) -> DataFrame:
    """DSH-10: PR count per repository, largest first."""
    per = fct_prs.groupBy("repo_id").agg(F.count(F.lit(1)).alias("pr_count"))
    return _by_repo_name(per, dim_repo).select("repo_id", "repo_full_name", "pr_count") \
        .orderBy(F.col("pr_count").desc(), F.col("repo_full_name").asc_nulls_last())


def commit_distribution(fct_commits: DataFrame, dim_repo: DataFrame) -> DataFrame:
    """DSH-12: commits per repository and share of all commits."""
    total = fct_commits.select(F.count(F.lit(1))).scalar()
    per = fct_commits.groupBy("repo_id").agg(F.count(F.lit(1)).alias("commits"))
    return _by_repo_name(per, dim_repo).select(
        "repo_id", "repo_full_name", "commits", (F.col("commits").cast("double") / total).alias("share"))


def activity_timeline(fct_commits: DataFrame, fct_prs: DataFrame, fct_reviews: DataFrame) -> DataFrame:
    """DSH-13: per (repo, ISO week): commits, PRs opened, reviews."""
    rows = (fct_commits.select("repo_id", week_start("committed_at").alias("week_start"), F.lit("commit").alias("kind"))
            .unionByName(fct_prs.select("repo_id", week_start("created_at").alias("week_start"), F.lit("pr").alias("kind")))
            .unionByName(fct_reviews.select("repo_id", week_start("submitted_at").alias("week_start"),
                                            F.lit("review").alias("kind")))
            .filter(F.col("week_start").isNotNull()))
    # a pivot by conditional aggregation: one shuffle with partial
    # aggregation (``groupBy().pivot()`` would aggregate twice)
    k = F.col("kind")
    return rows.groupBy("repo_id", "week_start").agg(
        F.count_if(k == "commit").alias("commits"),
        F.count_if(k == "pr").alias("prs"),
        F.count_if(k == "review").alias("reviews"))


def lines_by_repo(fct_commits: DataFrame, dim_repo: DataFrame) -> DataFrame:
    """DSH-14: additions, deletions and total changes per repository."""
    per = fct_commits.groupBy("repo_id").agg(
        F.sum("additions").alias("lines_added"), F.sum("deletions").alias("lines_deleted"),
        F.sum("total_changes").alias("lines_changed"))
    return _by_repo_name(per, dim_repo)


def code_velocity(fct_commits: DataFrame) -> DataFrame:
    """DSH-15: lines added and removed per ISO week."""
    return (fct_commits.select(week_start("committed_at").alias("week_start"), "additions", "deletions")
            .filter(F.col("week_start").isNotNull())
            .groupBy("week_start").agg(F.sum("additions").alias("lines_added"),
                                       F.sum("deletions").alias("lines_removed")))
