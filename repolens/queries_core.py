"""Registered queries: staging, mart and the flagship dashboard."""

from __future__ import annotations

from .catalog import O, register
from .plans import dashboards

# --- staging models (STG-01..05) and mart models (MRT-01..05) -----------------
for _name in ("stg_commits", "stg_pull_requests", "stg_reviews", "stg_repositories", "stg_languages",
              "dim_repository", "fct_commits", "fct_pull_requests", "fct_reviews"):
    register(_name, O.select_all(_name))(lambda w, _n=_name: w.build(_n))


@register("dsh_merge_rate", O.sql("""
SELECT r.repo_full_name,
       grouping(r.repo_full_name) = 1 AS is_total,
       count(*) AS pr_count,
       CAST(sum(CASE WHEN f.is_merged THEN 1 ELSE 0 END) AS BIGINT) AS merged_count,
       CAST(sum(CASE WHEN f.is_merged THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS merge_rate
FROM fct_pull_requests f LEFT JOIN dim_repository r ON f.repo_id = r.repo_id
GROUP BY ROLLUP (r.repo_full_name)""", "fct_pull_requests", "dim_repository"))
def dsh_merge_rate(w):
    return dashboards.merge_rate(w.fct_pull_requests, w.dim_repository)
