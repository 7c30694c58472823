"""Continuous landing: new JSON files -> raw tables, with Structured Streaming.

The file source remembers which files it has processed (in the checkpoint,
under ``spark.checkpoint.dir`` unless given), so each landed page is
loaded once even across restarts and lost executors; ``availableNow``
processes everything present and stops, which suits a scheduled run.
Each micro-batch is flattened, stamped with one ingestion instant,
split on REQUIRED columns and appended to the day-partitioned raw table.
If a micro-batch is retried after a failure, its rows may be appended
again with a later stamp; staging keeps the latest row per key, so such
repeats do not reach the mart.
"""

from __future__ import annotations

import datetime as _dt
import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.scalar import instant_wallclock
from ..operators import ingest as ING
from ..operators import sinks
from ..schemas import ENTITIES, JSON_SCHEMAS, LANDED_AT, REVIEW_ENVELOPE
from ..session import checkpoint_root
from ..sources.landing import file_path, language_map, objects, repo_of

_FLATTEN = {
    "repositories": ING.to_raw_repositories,
    "commits": ING.to_raw_commits,
    "pull_requests": ING.to_raw_pull_requests,
    "reviews": ING.to_raw_reviews,
    "languages": ING.to_raw_languages,
}


def _source(spark: SparkSession, landing: str, entity: str, max_files: int | None) -> DataFrame:
    path = f"{landing.rstrip('/')}/{entity}"
    r = spark.readStream.option("recursiveFileLookup", True)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    if entity == "languages":
        df = r.option("wholetext", True).text(path).withColumn("languages", language_map(F.col("value")))
    else:
        schema = REVIEW_ENVELOPE if entity == "reviews" else JSON_SCHEMAS[entity]
        df = r.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)
    df = df.withColumn("_file", file_path()).withColumn(
        LANDED_AT, instant_wallclock(F.col("_metadata.file_modification_time")))
    return objects(entity, df.withColumn("repo_full_name", repo_of("_file"))).drop("_file")


def default_checkpoint(spark: SparkSession, landing: str, root: str, entity: str) -> str:
    """A folder of the shared ``spark.checkpoint.dir`` itself (not of the
    sub-folder Spark makes for each application), named by source and target:
    a restarted application goes on where the last one ended."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or checkpoint_root(spark)
    name = hashlib.sha256(f"{landing.rstrip('/')}|{root.rstrip('/')}".encode()).hexdigest()[:16]
    return f"{base.rstrip('/')}/repolens-landing/{name}/{entity}"


def start_landing_stream(spark: SparkSession, landing: str, root: str, entity: str,
                         checkpoint_location: str | None = None, available_now: bool = True,
                         max_files_per_trigger: int | None = None,
                         processing_time: str = "1 minute") -> StreamingQuery:
    """Start loading ``<landing>/<entity>`` into ``<root>/raw/<table>``."""
    table = ENTITIES[entity]
    ckpt = checkpoint_location or default_checkpoint(spark, landing, root, entity)
    flat = _FLATTEN[entity](_source(spark, landing, entity, max_files_per_trigger))

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        ok, bad = ING.split_valid(ING.stamp(batch, now), table)
        sinks.append_rejected(bad, root, table)
        sinks.append_raw(ok, root, table)

    w = flat.writeStream.foreachBatch(load_batch).option("checkpointLocation", ckpt) \
        .queryName(f"landing_{entity}")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


def load_landed(spark: SparkSession, landing: str, root: str, entities=tuple(ENTITIES),
                checkpoint_root_dir: str | None = None) -> None:
    """Run an ``availableNow`` stream per entity to completion."""
    for e in entities:
        ck = f"{checkpoint_root_dir.rstrip('/')}/{e}" if checkpoint_root_dir else None
        q = start_landing_stream(spark, landing, root, e, ck)
        q.awaitTermination()      # however long it takes; raises if the stream failed
