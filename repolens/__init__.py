"""repolens: developer-activity analytics on Spark.

Layers: sources (JSON landing files, raw tables, derived test fixtures,
calendar spine) -> operators (ingest, dedup, merge, incremental state,
run accounting, data quality) -> plans (staging, mart, aggregates,
dashboards, refresh jobs).  Everything is expressed with DataFrame
operators so Catalyst/AQE choose the physical plan.
"""

__all__ = ["session", "schemas"]
