"""Session helpers.

The library never relies on the session time zone for its results: every
timestamp it produces is ``timestamp_ntz`` holding a UTC wall-clock value
(the parquet inputs carry naive timestamps, and ``timestamp_ntz``
arithmetic and date parts do not depend on ``spark.sql.session.timeZone``).
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import threading
from collections.abc import Iterator

from pyspark.sql import SparkSession

# Settings that matter at scale; all are plain public Spark options.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Partition overwrite must only touch the partitions being written
    # (merge of facts, section "partition-scoped merge" in the README).
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Settings intended for large cluster runs (100 TB class).  Shuffle
# partitions start high and AQE coalesces them toward the advisory size;
# skewed partitions above factor x median and 256 MB are split.
CLUSTER_CONF = {
    **DEFAULT_CONF,
    "spark.sql.shuffle.partitions": "16000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "repolens", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine's defaults.

    ``spark.checkpoint.dir`` is only set when the caller has not named one;
    on a cluster it must point at shared storage and is read from the
    session by :func:`checkpoint_root`.
    """
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


# Codec of the tables that jobs write: two thirds of the default's bytes.
CODEC = "zstd"

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_cleaning: dict[str, tuple[int, str | None]] = {}      # session -> writes under way, the setting before them
_cleaning_lock = threading.Lock()


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files: they go when the write
    ends, not when the driver happens to collect its plan, so a job of several
    writes holds the shuffles of one at a time.  The session's setting is put
    back after the last of the writes that run side by side."""
    session = spark._jsparkSession.sessionUUID()
    with _cleaning_lock:
        n, before = _cleaning.get(session, (0, None))
        if n == 0:
            before = spark.conf.get(_CLEANUP, None)
            spark.conf.set(_CLEANUP, "true")
        _cleaning[session] = n + 1, before
    try:
        yield
    finally:
        with _cleaning_lock:
            n, before = _cleaning.pop(session)
            if n > 1:
                _cleaning[session] = n - 1, before
            elif before is None:
                spark.conf.unset(_CLEANUP)
            else:
                spark.conf.set(_CLEANUP, before)


def checkpoint_root(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only when the setting is absent (local tests) a fresh folder is
    created and registered; on a cluster the setting must be provided.
    """
    sc = spark.sparkContext
    cur = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not cur:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage "
                               "(a machine-local folder does not survive executor loss)")
        cur = tempfile.mkdtemp(prefix="repolens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(cur)
    return sc.getCheckpointDir() or cur
