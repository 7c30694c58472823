"""Run accounting: per-step result rows and their summaries (RUN-01..04).

A run log is a DataFrame with the fixed ``RUN_LOG_SCHEMA``; summaries are
single aggregations over it (a run log has one row per entity and
repository, so it is small, but nothing here assumes that).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import ENTITIES, RUN_LOG_SCHEMA
from .ingest import load_metrics


def result_rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """RUN-01: build a run log from driver-side step results."""
    return spark.createDataFrame(rows, RUN_LOG_SCHEMA)


def results_from_metrics(metrics: DataFrame, entity: str, success: bool = True,
                         error: str | None = None, duration_ms: int | None = None) -> DataFrame:
    """RUN-01 from a per-repository ``load_metrics`` frame of one entity.

    "Extracted" is the number of rows handed to the loader.  "Loaded" is that
    of the accepted rows for commits, reviews and languages; for repositories
    and pull requests the source reports the length of the list instead."""
    n = F.col("total_rows").cast("bigint")
    loaded = n if entity in ("repositories", "pull_requests") else F.col("successful_rows").cast("bigint")
    return metrics.select(
        F.lit(entity).alias("entityType"),
        F.col("repo_full_name").alias("repoFullName"),
        n.alias("recordsExtracted"), loaded.alias("recordsLoaded"),
        F.lit(success).alias("success"),
        F.lit(error).cast("string").alias("errorMessage"),
        F.lit(duration_ms).cast("bigint").alias("durationMs"),
    )


def run_counts(results: DataFrame) -> DataFrame:
    """RUN-02: successful and failed steps, and whether any failed."""
    return results.agg(
        F.count_if(F.col("success")).alias("success_count"),
        F.count_if(~F.col("success")).alias("failure_count"),
        F.coalesce(F.bool_or(~F.col("success")), F.lit(False)).alias("has_failures"),
    )


def entity_list(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(e,) for e in ENTITIES], "entityType string")


def run_by_entity(spark: SparkSession, results: DataFrame) -> DataFrame:
    """RUN-03: extracted and loaded (summed over successful steps only) and
    failures per entity; an entity without steps reports zeros."""
    ok = F.col("success")
    g = results.groupBy("entityType").agg(
        F.sum(F.when(ok, F.col("recordsExtracted"))).cast("bigint").alias("extracted"),
        F.sum(F.when(ok, F.col("recordsLoaded"))).cast("bigint").alias("loaded"),
        F.count_if(~ok).alias("failures"),
    )
    j = F.broadcast(entity_list(spark)).join(g, "entityType", "left")  # five entity names
    return j.select("entityType",
                    F.coalesce("extracted", F.lit(0)).alias("extracted"),
                    F.coalesce("loaded", F.lit(0)).alias("loaded"),
                    F.coalesce("failures", F.lit(0)).alias("failures"))


def run_failures(results: DataFrame) -> DataFrame:
    """RUN-04: the failed steps with their error messages."""
    return results.filter(~F.col("success")).select("entityType", "repoFullName", "errorMessage")


def run_log_from_landed(landed: dict[str, DataFrame], error) -> DataFrame:
    """RUN-01 for a load of whole landed tables: one result row per (entity,
    repository) with the handed and accepted row counts.  ``error(entity,
    repository)`` gives the message of a step that failed (it loaded nothing),
    NULL for others."""
    parts = []
    for entity, table in ENTITIES.items():
        df = landed[table]
        if table == "raw_repositories":
            df = df.withColumnRenamed("full_name", "repo_full_name")
        parts.append(results_from_metrics(load_metrics(df, table, by=["repo_full_name"]), entity))
    message = error(F.col("entityType"), F.col("repoFullName"))
    zero = F.lit(0).cast("bigint")
    return reduce(DataFrame.unionByName, parts).withColumns({
        "errorMessage": message, "success": message.isNull(),
        "recordsExtracted": F.when(message.isNull(), F.col("recordsExtracted")).otherwise(zero),
        "recordsLoaded": F.when(message.isNull(), F.col("recordsLoaded")).otherwise(zero)})
