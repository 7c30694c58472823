"""Tables of immutable folders behind a versioned manifest.

    <path>/data/c=<commit>[/<partition>=<value>]/*.parquet   never changed once written
    <path>/_manifest/v=<n>/                                  which folders are version n

A commit writes its folders first and the manifest last; a manifest counts
once its ``_SUCCESS`` marker exists.  So readers see a version whole or not at
all: a writer that dies at any point leaves the version before it in place,
and its stray folders are removed by a later commit.  Replacing one partition
writes that partition only; the others stay the same files.  A manifest has
one row a folder (months of a fact, buckets of an index): its size does not
grow with the rows.  One writer at a time: two that commit the same number
fail on the second manifest.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import CODEC, shuffles_dropped
from . import sinks

COMMIT = "c"
KEEP = 2            # versions whose folders stay: readers of the one before go on undisturbed
_NULL = "__HIVE_DEFAULT_PARTITION__"
_MANIFEST = "part string, folder string, schema string"


def _manifest(path: str) -> str:
    return f"{path.rstrip('/')}/_manifest"


def _data(path: str) -> str:
    return f"{path.rstrip('/')}/data"


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n[2:]) for n in sinks.list_dirs(spark, _manifest(path)) if n.startswith("v=") and n[2:].isdigit())


def versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions, oldest first."""
    return [n for n in _numbers(spark, path) if sinks.exists(spark, f"{_manifest(path)}/v={n}/_SUCCESS")]


def exists(spark: SparkSession, path: str) -> bool:
    return bool(versions(spark, path))


def entries(spark: SparkSession, path: str, version: int | None = None) -> list:
    """Rows (part, folder, schema) of a version (default: the newest)."""
    known = versions(spark, path)
    if not known or version is not None and version not in known:
        raise FileNotFoundError(f"{path}: no such version of a table ({version}; complete are {known})")
    n = known[-1] if version is None else version
    return spark.read.schema(_MANIFEST).parquet(f"{_manifest(path)}/v={n}").collect()


def read(spark: SparkSession, path: str, parts: Collection[str | None] | None = None, version: int | None = None) -> DataFrame:
    """A version of the table; with ``parts`` only the folders of these
    partition values are listed and read."""
    rows = entries(spark, path, version)
    schema = T.StructType.fromJson(json.loads(rows[0]["schema"]))
    folders = [r["folder"] for r in rows if r["folder"] is not None and (parts is None or r["part"] in parts)]
    return _read(spark, path, folders, schema)


def _read(spark: SparkSession, path: str, folders: list[str], schema: T.StructType) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    with_commit = T.StructType([*schema.fields, T.StructField(COMMIT, T.StringType())])
    base = _data(path)
    return spark.read.schema(with_commit).option("basePath", base).parquet(*[f"{base}/{f}" for f in folders]).drop(COMMIT)


@dataclass
class Staged:
    """Folders that are written but belong to no version yet."""
    folders: list[tuple[str | None, str]]      # partition value, folder
    schema: T.StructType


def stage(spark: SparkSession, df: DataFrame, path: str, partition: str | None = None) -> Staged:
    """Write ``df`` into folders of its own."""
    numbers = _numbers(spark, path)
    commit = f"{COMMIT}={numbers[-1] + 1 if numbers else 0:06d}-{uuid.uuid4().hex[:8]}"
    fields = [f for f in df.schema.fields if f.name != partition] + [f for f in df.schema.fields if f.name == partition]
    writer = df.write.mode("errorifexists").option("compression", CODEC)
    with shuffles_dropped(spark):
        (writer.partitionBy(partition) if partition else writer).parquet(f"{_data(path)}/{commit}")
    folders: list[tuple[str | None, str]] = [(None, commit)]
    if partition:
        names = [x for x in sinks.list_dirs(spark, f"{_data(path)}/{commit}") if x.startswith(f"{partition}=")]
        folders = [(None if x == f"{partition}={_NULL}" else x[len(partition) + 1:], f"{commit}/{x}") for x in names]
    return Staged(folders, T.StructType([T.StructField(f.name, f.dataType, True) for f in fields]))


def read_staged(spark: SparkSession, path: str, staged: Staged) -> DataFrame:
    return _read(spark, path, [f for _, f in staged.folders], staged.schema)


def commit(spark: SparkSession, path: str, staged: Staged, replace: Collection[str | None] | None = None) -> int:
    """Make ``staged`` part of the next version and return its number.

    ``replace=None``: it is the whole table.  Otherwise it takes the place of
    the partition values in ``replace`` (one without rows is gone), and the
    folders of all others go on as they are; ``replace=()`` appends."""
    numbers = _numbers(spark, path)
    n = numbers[-1] + 1 if numbers else 0
    kept = [] if replace is None or not exists(spark, path) else [
        (r["part"], r["folder"]) for r in entries(spark, path) if r["folder"] is not None and r["part"] not in replace]
    schema = staged.schema.json()
    rows = [(p, f, schema) for p, f in kept + staged.folders] or [(None, None, schema)]
    spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("errorifexists").parquet(f"{_manifest(path)}/v={n}")
    vacuum(spark, path)
    return n


def publish(spark: SparkSession, df: DataFrame, path: str, partition: str | None = None,
            replace: Collection[str | None] | None = None) -> int:
    """``stage`` and ``commit`` in one."""
    return commit(spark, path, stage(spark, df, path, partition), replace)


def vacuum(spark: SparkSession, path: str, keep: int = KEEP) -> None:
    """Remove versions before the newest ``keep``, and folders that no
    remaining version names (also those of broken commits)."""
    stay = versions(spark, path)[-keep:]
    if not stay:
        return
    for n in _numbers(spark, path):
        if n < stay[0] or n < stay[-1] and n not in stay:
            sinks.delete(spark, f"{_manifest(path)}/v={n}")
    named = {r["folder"] for n in stay for r in entries(spark, path, n) if r["folder"] is not None}
    for commit in sinks.list_dirs(spark, _data(path)):
        if commit in named:
            continue
        if not any(f.startswith(f"{commit}/") for f in named):
            sinks.delete(spark, f"{_data(path)}/{commit}")
            continue
        for part in sinks.list_dirs(spark, f"{_data(path)}/{commit}"):
            if f"{commit}/{part}" not in named:
                sinks.delete(spark, f"{_data(path)}/{commit}/{part}")
