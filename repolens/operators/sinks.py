"""Sinks: raw append with day partitions and clustering, layer/table
creation, full refresh, staging views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import (CLUSTER_KEYS, LANDED_AT, PARTITION_COLUMN, RAW_SCHEMAS, ROW_KEYS, WATERMARK_SCHEMA,
                       WATERMARK_TABLE)

LAYERS = ("raw", "staging", "mart")


def table_path(root: str, layer: str, table: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{table}"


def with_partition_column(df: DataFrame) -> DataFrame:
    return df.withColumn(PARTITION_COLUMN, F.to_date("ingestion_timestamp"))


def clustered(df: DataFrame, table: str, partitions: int | None = None) -> DataFrame:
    """SNK-02: range-partition by (day, cluster keys, row key) and sort inside
    each task, so every written file covers a narrow key range and parquet
    min/max statistics prune scans filtering on the cluster keys.  Equal
    keys always share a range; the row key at the end is what cuts a hot
    cluster key into several ranges."""
    keys = [PARTITION_COLUMN] + CLUSTER_KEYS[table] + ROW_KEYS[table]
    out = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    return out.sortWithinPartitions(*keys)


def append_raw(df: DataFrame, root: str, table: str, partitions: int | None = None) -> None:
    """SNK-01: append to ``root/raw/<table>`` partitioned by ingestion day."""
    out = clustered(with_partition_column(df), table, partitions)
    out.write.mode("append").partitionBy(PARTITION_COLUMN).parquet(table_path(root, "raw", table))


def append_rejected(bad: DataFrame, root: str, table: str) -> None:
    """ING-07: rows that miss REQUIRED columns, with their ``errors``, go to
    ``root/raw/_rejected/<table>`` (day partitions), not away."""
    with_partition_column(bad).write.mode("append").partitionBy(PARTITION_COLUMN) \
        .parquet(rejected_path(root, table))


def rejected_path(root: str, table: str) -> str:
    return table_path(root, "raw", f"_rejected/{table}")


def read_rejected(spark: SparkSession, root: str, table: str) -> DataFrame:
    schema = T.StructType([*RAW_SCHEMAS[table].fields, T.StructField("errors", T.ArrayType(T.StringType())),
                           T.StructField(PARTITION_COLUMN, T.DateType())])
    path = rejected_path(root, table)
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def ensure_layers(spark: SparkSession, root: str) -> list[str]:
    """SNK-03: create the three layer folders if missing (idempotent)."""
    made = []
    for layer in LAYERS:
        p = f"{root.rstrip('/')}/{layer}"
        _fs(spark, p)[0].mkdirs(_fs(spark, p)[1])
        made.append(p)
    return made


def ensure_tables(spark: SparkSession, root: str) -> list[str]:
    """SNK-04: create the five raw tables (empty, with their schema and day
    partition column) and the table of extraction marks (its first version,
    without rows) if they do not exist; existing tables are never altered."""
    created = []
    for table in RAW_SCHEMAS:
        p = table_path(root, "raw", table)
        if exists(spark, p):
            continue
        empty = spark.createDataFrame([], _stored_schema(table))
        empty.write.mode("errorifexists").partitionBy(PARTITION_COLUMN).parquet(p)
        created.append(table)
    p = table_path(root, "raw", WATERMARK_TABLE)
    if not exists(spark, p):
        spark.createDataFrame([], WATERMARK_SCHEMA).write.mode("errorifexists").parquet(f"{p}/v=0")
        created.append(WATERMARK_TABLE)
    return created


def read_raw(spark: SparkSession, root: str, table: str) -> DataFrame:
    """SRC-07: scan a raw table with its declared schema plus the landing
    instant and the day column (partition pruning on ``ingestion_date``)."""
    return spark.read.schema(_stored_schema(table)).parquet(table_path(root, "raw", table))


def _stored_schema(table: str) -> T.StructType:
    return T.StructType([*RAW_SCHEMAS[table].fields, T.StructField(LANDED_AT, T.TimestampNTZType()),
                         T.StructField(PARTITION_COLUMN, T.DateType())])


def overwrite_table(df: DataFrame, path: str) -> None:
    """SNK-06: full refresh (dimensions).  Never used on a path the same
    plan reads (static overwrite deletes the input first)."""
    df.write.mode("overwrite").parquet(path)


def _fs(spark: SparkSession, path: str):
    """Hadoop file system and path object for ``path`` (any scheme the
    cluster supports: hdfs, s3a, abfs, file)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders of ``path`` (empty if it does not exist)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True))
