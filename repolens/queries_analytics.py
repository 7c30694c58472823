"""Registered aggregate (AGG) and dashboard (DSH) queries with oracle SQL."""

from __future__ import annotations

import datetime as _dt

from .catalog import O, register
from .plans import analytics as A
from .plans import dashboards as D

# Fixed "as of" day for the streak dashboard in registered queries.
STREAK_AS_OF = _dt.date(2024, 1, 31)

O.cte("activity", """
SELECT CAST(committed_at AS DATE) AS activity_date, repo_id, 1 AS is_commit, 0 AS is_pr, total_changes AS lines
FROM fct_commits
UNION ALL
SELECT CAST(created_at AS DATE), repo_id, 0, 1, 0 FROM fct_pull_requests""", "fct_commits", "fct_pull_requests")

_ACT = """CAST(sum(is_commit) AS BIGINT) AS commits, CAST(sum(is_pr) AS BIGINT) AS prs_created,
       CAST(sum(lines) AS BIGINT) AS lines_changed, count(DISTINCT repo_id) AS active_repos"""


@register("agg_daily_activity", O.sql(f"""
SELECT activity_date, {_ACT} FROM activity WHERE activity_date IS NOT NULL GROUP BY activity_date""", "activity"))
def agg_daily_activity(w):
    return w.build("agg_daily_activity")


@register("agg_weekly_activity", O.sql(f"""
SELECT *, commits - lag(commits) OVER (ORDER BY week_start) AS commits_change FROM (
  SELECT CAST(date_trunc('week', activity_date) AS DATE) AS week_start, {_ACT}
  FROM activity WHERE activity_date IS NOT NULL GROUP BY 1)""", "activity"))
def agg_weekly_activity(w):
    return w.build("agg_weekly_activity")


@register("agg_monthly_activity", O.sql(f"""
SELECT CAST(date_trunc('month', activity_date) AS DATE) AS month_start, {_ACT}
FROM activity WHERE activity_date IS NOT NULL GROUP BY 1""", "activity"))
def agg_monthly_activity(w):
    return w.build("agg_monthly_activity")


O.cte("language_bytes_by_month", """
SELECT month_start, language_name, CAST(sum(byte_count) AS BIGINT) AS bytes,
       count(DISTINCT repo_full_name) AS repo_count
FROM (SELECT *, row_number() OVER (PARTITION BY month_start, repo_full_name, language_name
                                   ORDER BY ingestion_timestamp DESC NULLS LAST, byte_count DESC NULLS LAST) AS rn
      FROM (SELECT *, CAST(date_trunc('month', ingestion_timestamp) AS DATE) AS month_start FROM raw_languages))
WHERE rn = 1
GROUP BY month_start, language_name""", "raw_languages")


@register("agg_language_usage", O.sql("""
SELECT month_start, language_name,
       coalesce(b.bytes, 0) AS bytes, coalesce(b.repo_count, 0) AS repo_count,
       coalesce(c.commit_count, 0) AS commit_count
FROM language_bytes_by_month b
FULL OUTER JOIN (
  SELECT CAST(date_trunc('month', f.committed_at) AS DATE) AS month_start, r.primary_language AS language_name,
         count(*) AS commit_count
  FROM fct_commits f JOIN dim_repository r ON f.repo_id = r.repo_id
  WHERE f.committed_at IS NOT NULL AND r.primary_language IS NOT NULL
  GROUP BY 1, 2) c USING (month_start, language_name)""",
        "language_bytes_by_month", "fct_commits", "dim_repository"))
def agg_language_usage(w):
    return w.build("agg_language_usage")


_HEATMAP_SQL = O.sql("""
SELECT g.day_of_week, g.hour_of_day, coalesce(c.commits, 0) AS commits
FROM (SELECT i // 24 + 1 AS day_of_week, i % 24 AS hour_of_day FROM range(168) t(i)) g
LEFT JOIN (SELECT day_of_week, hour_of_day, count(*) AS commits FROM fct_commits GROUP BY 1, 2) c
  ON g.day_of_week = c.day_of_week AND g.hour_of_day = c.hour_of_day""", "fct_commits")


@register("agg_hourly_heatmap", _HEATMAP_SQL)
def agg_hourly_heatmap(w):
    return w.build("agg_hourly_heatmap")


@register("agg_dim_language", O.sql("""
SELECT CAST(('0x' || substr(md5(n), 1, 15)) AS BIGINT) AS language_id, n AS language_name
FROM (SELECT language_name AS n FROM stg_languages UNION SELECT primary_language FROM stg_repositories)
WHERE n IS NOT NULL""", "stg_languages", "stg_repositories"))
def agg_dim_language(w):
    return A.dim_language(w.stg_languages, w.stg_repositories)


_PIVOT_COLS = ",\n       ".join(
    f"CAST(sum(CASE WHEN rk = {k} THEN byte_count END) AS BIGINT) AS top{k}_bytes" for k in range(1, A.TOP_LANGUAGES + 1))


@register("agg_languages_pivot", O.sql(f"""
SELECT repo_full_name,
       {_PIVOT_COLS},
       CAST(sum(CASE WHEN rk IS NULL THEN byte_count END) AS BIGINT) AS other_bytes
FROM stg_languages s LEFT JOIN (
  SELECT language_name, row_number() OVER (ORDER BY total DESC, language_name) AS rk
  FROM (SELECT language_name, sum(byte_count) AS total FROM stg_languages GROUP BY 1)
  QUALIFY rk <= {A.TOP_LANGUAGES}) t USING (language_name)
GROUP BY repo_full_name""", "stg_languages"))
def agg_languages_pivot(w):
    return A.languages_pivot(w.stg_languages)


@register("agg_review_count", O.sql("""
SELECT p.pr_key, coalesce(n, 0) AS review_count
FROM fct_pull_requests p
LEFT JOIN (SELECT pr_key, count(*) AS n FROM fct_reviews WHERE pr_key IS NOT NULL GROUP BY 1) r USING (pr_key)""",
        "fct_pull_requests", "fct_reviews"))
def agg_review_count(w):
    return A.review_counts(w.fct_pull_requests, w.fct_reviews)


O.cte("commit_days", """
SELECT CAST(committed_at AS DATE) AS d, count(*) AS commits FROM fct_commits
WHERE committed_at IS NOT NULL GROUP BY 1""", "fct_commits")


@register("dsh_commit_trend", O.sql("""
SELECT 'day' AS grain, d AS period_start, commits FROM commit_days
UNION ALL
SELECT 'week', CAST(date_trunc('week', d) AS DATE), CAST(sum(commits) AS BIGINT) FROM commit_days GROUP BY 2
UNION ALL
SELECT 'month', CAST(date_trunc('month', d) AS DATE), CAST(sum(commits) AS BIGINT) FROM commit_days GROUP BY 2""",
        "commit_days"))
def dsh_commit_trend(w):
    return D.commit_trend(w.agg_daily_activity)


@register("dsh_streaks", O.sql(f"""
WITH days AS (
  SELECT DISTINCT author_name, CAST(committed_at AS DATE) AS d FROM fct_commits
  WHERE author_name IS NOT NULL AND committed_at IS NOT NULL AND CAST(committed_at AS DATE) <= DATE '{STREAK_AS_OF}'),
runs AS (
  SELECT author_name, count(*) AS n, max(d) AS end_d FROM (
    SELECT author_name, d, d - CAST(row_number() OVER (PARTITION BY author_name ORDER BY d) AS INTEGER) AS grp
    FROM days) GROUP BY author_name, grp)
SELECT author_name, max(n) AS longest_streak,
       coalesce(max(CASE WHEN end_d >= DATE '{STREAK_AS_OF}' - 1 THEN n END), 0) AS current_streak
FROM runs GROUP BY author_name""", "fct_commits"))
def dsh_streaks(w):
    return D.streaks(w.fct_commits, STREAK_AS_OF)


@register("dsh_rolling_avg", O.sql("""
WITH spine AS (
  SELECT CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS d FROM commit_days),
dense AS (SELECT s.d, coalesce(c.commits, 0) AS commits FROM spine s LEFT JOIN commit_days c USING (d))
SELECT d AS activity_date, commits,
       CAST(sum(commits) OVER (ORDER BY d ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS DOUBLE) / 30
         AS rolling_avg_30d
FROM dense""", "commit_days"))
def dsh_rolling_avg(w):
    return D.rolling_average(w.fct_commits)


@register("dsh_rolling_avg_author", O.sql("""
WITH spine AS (
  SELECT CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS d FROM commit_days),
per_day AS (
  SELECT author_name, CAST(committed_at AS DATE) AS d, count(*) AS commits FROM fct_commits
  WHERE author_name IS NOT NULL AND committed_at IS NOT NULL GROUP BY 1, 2),
dense AS (
  SELECT a.author_name, s.d, coalesce(p.commits, 0) AS commits
  FROM (SELECT DISTINCT author_name FROM per_day) a CROSS JOIN spine s LEFT JOIN per_day p USING (author_name, d))
SELECT author_name, d AS activity_date, commits,
       CAST(sum(commits) OVER (PARTITION BY author_name ORDER BY d ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS DOUBLE) / 30
         AS rolling_avg_30d
FROM dense""", "commit_days", "fct_commits"))
def dsh_rolling_avg_author(w):
    return D.rolling_average_by_author(w.fct_commits)


@register("dsh_language_share", O.sql("""
SELECT language_name, CAST(sum(byte_count) AS BIGINT) AS bytes,
       CAST(sum(byte_count) AS DOUBLE) / (SELECT CAST(sum(byte_count) AS DOUBLE) FROM stg_languages) AS share
FROM stg_languages GROUP BY 1""", "stg_languages"))
def dsh_language_share(w):
    return D.language_share(w.stg_languages)


@register("dsh_language_trend", O.sql("""
SELECT month_start, language_name, bytes,
       CAST(bytes AS DOUBLE) / CAST(sum(bytes) OVER (PARTITION BY month_start) AS DOUBLE) AS share_of_month
FROM language_bytes_by_month""", "language_bytes_by_month"))
def dsh_language_trend(w):
    return D.language_trend(w.agg_language_usage)


@register("dsh_top_repos_per_language", O.sql(f"""
SELECT language_name, repo_full_name, byte_count,
       row_number() OVER (PARTITION BY language_name ORDER BY byte_count DESC, repo_full_name) AS rank
FROM stg_languages QUALIFY rank <= {D.TOP_REPOS}""", "stg_languages"))
def dsh_top_repos_per_language(w):
    return D.top_repositories_per_language(w.stg_languages)


@register("dsh_merge_time_buckets", O.sql("""
SELECT CASE WHEN time_to_merge_hours < 1 THEN '0-1h' WHEN time_to_merge_hours < 4 THEN '1-4h'
            WHEN time_to_merge_hours < 24 THEN '4-24h' WHEN time_to_merge_hours < 72 THEN '24-72h'
            ELSE '72h+' END AS bucket,
       count(*) AS pr_count
FROM fct_pull_requests WHERE is_merged AND time_to_merge_hours IS NOT NULL GROUP BY 1""", "fct_pull_requests"))
def dsh_merge_time_buckets(w):
    return D.merge_time_buckets(w.fct_pull_requests)


@register("dsh_merge_time_percentiles", O.sql("""
SELECT count(*) AS merged_prs,
       round(quantile_cont(time_to_merge_hours, 0.5), 6) AS p50_hours,
       round(quantile_cont(time_to_merge_hours, 0.9), 6) AS p90_hours
FROM fct_pull_requests WHERE is_merged AND time_to_merge_hours IS NOT NULL""", "fct_pull_requests"))
def dsh_merge_time_percentiles(w):
    return D.merge_time_percentiles(w.fct_pull_requests)


@register("dsh_review_turnaround", O.sql("""
SELECT CAST(date_trunc('month', p.created_at) AS DATE) AS month_start, count(*) AS pr_count,
       CAST(sum(date_sub('hour', p.created_at, r.first_review_at)) AS DOUBLE) / count(*) AS mean_hours,
       round(quantile_cont(date_sub('hour', p.created_at, r.first_review_at), 0.5), 6) AS median_hours
FROM fct_pull_requests p
JOIN (SELECT pr_key, min(submitted_at) AS first_review_at FROM fct_reviews WHERE pr_key IS NOT NULL GROUP BY 1) r
  USING (pr_key)
WHERE date_sub('hour', p.created_at, r.first_review_at) IS NOT NULL
GROUP BY 1""", "fct_pull_requests", "fct_reviews"))
def dsh_review_turnaround(w):
    return D.review_turnaround(w.fct_pull_requests, w.fct_reviews)


@register("dsh_pr_volume_by_repo", O.sql("""
SELECT f.repo_id, r.repo_full_name, f.pr_count
FROM (SELECT repo_id, count(*) AS pr_count FROM fct_pull_requests GROUP BY 1) f
LEFT JOIN dim_repository r USING (repo_id)""", "fct_pull_requests", "dim_repository"))
def dsh_pr_volume_by_repo(w):
    return D.pr_volume_by_repo(w.fct_pull_requests, w.dim_repository)


@register("dsh_commit_distribution", O.sql("""
SELECT f.repo_id, r.repo_full_name, f.commits,
       CAST(f.commits AS DOUBLE) / (SELECT count(*) FROM fct_commits) AS share
FROM (SELECT repo_id, count(*) AS commits FROM fct_commits GROUP BY 1) f
LEFT JOIN dim_repository r USING (repo_id)""", "fct_commits", "dim_repository"))
def dsh_commit_distribution(w):
    return D.commit_distribution(w.fct_commits, w.dim_repository)


@register("dsh_activity_timeline", O.sql("""
SELECT repo_id, week_start,
       count(*) FILTER (WHERE kind = 'commit') AS commits,
       count(*) FILTER (WHERE kind = 'pr') AS prs,
       count(*) FILTER (WHERE kind = 'review') AS reviews
FROM (SELECT repo_id, CAST(date_trunc('week', committed_at) AS DATE) AS week_start, 'commit' AS kind FROM fct_commits
      UNION ALL SELECT repo_id, CAST(date_trunc('week', created_at) AS DATE), 'pr' FROM fct_pull_requests
      UNION ALL SELECT repo_id, CAST(date_trunc('week', submitted_at) AS DATE), 'review' FROM fct_reviews)
WHERE week_start IS NOT NULL
GROUP BY repo_id, week_start""", "fct_commits", "fct_pull_requests", "fct_reviews"))
def dsh_activity_timeline(w):
    return D.activity_timeline(w.fct_commits, w.fct_pull_requests, w.fct_reviews)


@register("dsh_lines_by_repo", O.sql("""
SELECT f.repo_id, r.repo_full_name, f.lines_added, f.lines_deleted, f.lines_changed
FROM (SELECT repo_id, CAST(sum(additions) AS BIGINT) AS lines_added, CAST(sum(deletions) AS BIGINT) AS lines_deleted,
             CAST(sum(total_changes) AS BIGINT) AS lines_changed
      FROM fct_commits GROUP BY 1) f
LEFT JOIN dim_repository r USING (repo_id)""", "fct_commits", "dim_repository"))
def dsh_lines_by_repo(w):
    return D.lines_by_repo(w.fct_commits, w.dim_repository)


@register("dsh_code_velocity", O.sql("""
SELECT CAST(date_trunc('week', committed_at) AS DATE) AS week_start,
       CAST(sum(additions) AS BIGINT) AS lines_added, CAST(sum(deletions) AS BIGINT) AS lines_removed
FROM fct_commits WHERE committed_at IS NOT NULL GROUP BY 1""", "fct_commits"))
def dsh_code_velocity(w):
    return D.code_velocity(w.fct_commits)
