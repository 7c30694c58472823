"""Table schemas, REQUIRED columns and cluster keys of the raw layer.

Raw column lists follow the warehouse schema of the ingest side: every
timestamp is stored as ``timestamp_ntz`` holding UTC wall-clock time.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, L, B, TS = T.StringType(), T.LongType(), T.BooleanType(), T.TimestampNTZType()


def _schema(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


RAW_SCHEMAS: dict[str, T.StructType] = {
    "raw_commits": _schema(
        ("sha", S), ("repo_full_name", S), ("author_name", S), ("author_email", S),
        ("author_date", TS), ("message", S), ("additions", L), ("deletions", L),
        ("changed_files", L), ("ingestion_timestamp", TS)),
    "raw_pull_requests": _schema(
        ("number", L), ("repo_full_name", S), ("title", S), ("state", S), ("user_login", S),
        ("created_at", TS), ("updated_at", TS), ("merged_at", TS), ("merge_commit_sha", S),
        ("ingestion_timestamp", TS)),
    "raw_reviews": _schema(
        ("id", L), ("repo_full_name", S), ("pr_number", L), ("user_login", S), ("state", S),
        ("submitted_at", TS), ("body", S), ("ingestion_timestamp", TS)),
    "raw_repositories": _schema(
        ("id", L), ("name", S), ("full_name", S), ("owner_login", S), ("language", S),
        ("created_at", TS), ("updated_at", TS), ("visibility", S), ("fork", B),
        ("stargazers_count", L), ("ingestion_timestamp", TS)),
    "raw_languages": _schema(
        ("repo_full_name", S), ("language_name", S), ("byte_count", L), ("ingestion_timestamp", TS)),
}

# REQUIRED (non-null) columns per raw table; rows violating them are rejected at load.
REQUIRED: dict[str, list[str]] = {
    "raw_commits": ["sha", "ingestion_timestamp"],
    "raw_pull_requests": ["number", "ingestion_timestamp"],
    "raw_reviews": ["id", "ingestion_timestamp"],
    "raw_repositories": ["id", "ingestion_timestamp"],
    "raw_languages": ["ingestion_timestamp"],
}

# Clustering columns of each raw table (rows are range-partitioned and
# sorted by them inside each day partition, so parquet min/max statistics
# prune scans that filter on them).
CLUSTER_KEYS: dict[str, list[str]] = {
    "raw_commits": ["repo_full_name"],
    "raw_pull_requests": ["repo_full_name", "state"],
    "raw_reviews": ["repo_full_name"],
    "raw_repositories": ["language"],
    "raw_languages": ["repo_full_name"],
}

# Columns that tell the rows of one cluster key apart: last in the write
# order, so a hot cluster key is cut into several ranges.
ROW_KEYS: dict[str, list[str]] = {
    "raw_commits": ["sha"],
    "raw_pull_requests": ["number"],
    "raw_reviews": ["id"],
    "raw_repositories": ["id"],
    "raw_languages": ["language_name"],
}

# Entity name -> raw table.
ENTITIES: dict[str, str] = {
    "repositories": "raw_repositories",
    "commits": "raw_commits",
    "pull_requests": "raw_pull_requests",
    "reviews": "raw_reviews",
    "languages": "raw_languages",
}

PARTITION_COLUMN = "ingestion_date"
# When the file of a row landed (UTC wall clock); raw tables keep it behind their declared columns.
LANDED_AT = "landed_at"

# Fact tables: the timestamp that decides the event-month partition, and the merge key.
FACT_EVENT_TS = {"fct_commits": "committed_at", "fct_pull_requests": "created_at", "fct_reviews": "submitted_at"}
FACT_KEY = {"fct_commits": "commit_sha", "fct_pull_requests": "pr_key", "fct_reviews": "review_id"}

# Files of the landing folders whose rows are in the raw tables.
LEDGER_SCHEMA = T.StructType([
    T.StructField("path", S), T.StructField("modified", T.TimestampType()), T.StructField("repoFullName", S),
    T.StructField("records", L),          # objects in the file
    T.StructField("kept", L),             # of these, handed to the loader
    T.StructField("waits", T.ArrayType(L)),   # pull requests of its reviews that were not in scope yet
    T.StructField("run", TS),
])

WATERMARK_TABLE = "_extraction_metadata"
WATERMARK_SCHEMA = T.StructType([
    T.StructField("entity_type", S, False),
    T.StructField("last_extracted_at", TS, False),
    T.StructField("updated_at", TS, True),
])

RUN_LOG_SCHEMA = T.StructType([
    T.StructField("entityType", S, True),
    T.StructField("repoFullName", S, True),
    T.StructField("recordsExtracted", L, True),
    T.StructField("recordsLoaded", L, True),
    T.StructField("success", B, True),
    T.StructField("errorMessage", S, True),
    T.StructField("durationMs", L, True),
])

# JSON documents as they land from the source API.  An explicit schema
# ignores unknown fields and yields NULL for missing ones.
_USER = T.StructType([T.StructField("login", S), T.StructField("id", L)])
JSON_SCHEMAS: dict[str, T.StructType] = {
    "commits": T.StructType([
        T.StructField("sha", S),
        T.StructField("commit", T.StructType([
            T.StructField("message", S),
            T.StructField("author", T.StructType([
                T.StructField("name", S), T.StructField("email", S), T.StructField("date", S)])),
        ])),
        T.StructField("author", _USER),
        T.StructField("stats", T.StructType([
            T.StructField("additions", T.IntegerType()), T.StructField("deletions", T.IntegerType()),
            T.StructField("total", T.IntegerType())])),
    ]),
    "pull_requests": T.StructType([
        T.StructField("number", T.IntegerType()), T.StructField("title", S), T.StructField("state", S),
        T.StructField("created_at", S), T.StructField("updated_at", S), T.StructField("merged_at", S),
        T.StructField("merge_commit_sha", S), T.StructField("user", _USER),
    ]),
    "reviews": T.StructType([
        T.StructField("id", L), T.StructField("state", S), T.StructField("submitted_at", S),
        T.StructField("body", S), T.StructField("user", _USER),
    ]),
    "repositories": T.StructType([
        T.StructField("id", L), T.StructField("name", S), T.StructField("full_name", S),
        T.StructField("owner", T.StructType([T.StructField("login", S)])),
        T.StructField("language", S), T.StructField("created_at", S), T.StructField("updated_at", S),
        T.StructField("visibility", S), T.StructField("fork", B), T.StructField("stargazers_count", L),
    ]),
}
# A reviews file holds either the reviews of the pull request its folder names, or an envelope a pull request.
REVIEW_ENVELOPE = T.StructType([*JSON_SCHEMAS["reviews"].fields, T.StructField("pr_number", L),
                                T.StructField("reviews", T.ArrayType(JSON_SCHEMAS["reviews"]))])
