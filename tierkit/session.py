"""Session construction and the shared scratch location.

On a cluster the session is built by the platform; ``build_session`` is for
local runs and tests.  ``scratch_root`` returns the shared folder named by
``spark.checkpoint.dir`` and only invents one (machine-local) when the session
has none, which is the local/test case.
"""

from __future__ import annotations

import math
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every tierkit job relies on.  AQE re-plans joins/partition counts at
# runtime from real shuffle statistics, splits skewed join/rebalance partitions
# and coalesces small ones, so no fixed partition count is hard-coded anywhere.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "static",
    # Arrow batches for pandas UDFs are cut by bytes too, not only by 10,000
    # rows: whole documents (up to ~150 KB each) cannot make a batch huge.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
}


def build_session(master: str | None = None, app_name: str = "tierkit",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Local/test builder.  Cluster jobs should keep the platform's session."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(SCALE_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    conf["spark.sql.execution.arrow.pyspark.enabled"] = "true"
    # checkpoint files of a DataFrame go when it is garbage-collected
    conf["spark.cleaner.referenceTracking.cleanCheckpoints"] = "true"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables and checkpoints.

    Reads ``spark.checkpoint.dir`` from the session.  Only when it is unset
    *and* the session runs in local mode (local runs, tests) a fresh local
    folder is created and registered as the checkpoint dir, so
    ``DataFrame.checkpoint()`` works too.  On a cluster an unset setting is an
    error: a machine-local folder is not shared by the executors.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset conf raises on some versions
            root = None
    if not root:
        root = sc.getCheckpointDir()
        if root:
            # getCheckpointDir appends a per-application uuid folder.
            root = os.path.dirname(root.rstrip("/"))
    if not root:
        if not (sc.master or "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster "
                               "(intermediate tables and checkpoints are written there)")
        root = tempfile.mkdtemp(prefix="tierkit-scratch-")
        sc.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    elif sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared scratch root."""
    return f"{scratch_root(spark)}/tierkit/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Remove all folders that ``scratch_path`` named under the session's scratch root (when no result
    is read any more)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{scratch_root(spark)}/tierkit")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


# Bytes of input per shuffle partition before AQE merges small ones.  The
# exchanges sized here carry what a partial limit or aggregate leaves of the
# input, at most the input: sort buffers of such a partition spill at worst.
TARGET_SHUFFLE_INPUT_BYTES = 256 * 1024 * 1024
# Map tasks times reduce partitions is what the driver keeps track of: beyond
# this count partitions grow instead, and spill.
MAX_SHUFFLE_PARTITIONS = 20_000
# Bytes of an Arrow batch in a job's session.  A Python worker holds several batches at once (read, worked on, sent
# back) and each core of an executor has a worker: at Spark's 64 MB they take what the batches' texts happen to weigh.
ARROW_BATCH_BYTES = 2 * 1024 * 1024
_SHUFFLE_KEYS = ("spark.sql.shuffle.partitions",
                 "spark.sql.adaptive.coalescePartitions.initialPartitionNum")


def shuffle_partitions_for(spark: SparkSession, input_bytes: int,
                           target_bytes: int = TARGET_SHUFFLE_INPUT_BYTES) -> int:
    """Shuffle partitions for ``input_bytes`` of input: one per ``target_bytes``, never fewer than the
    cluster's task slots nor more than ``MAX_SHUFFLE_PARTITIONS``."""
    n = max(spark.sparkContext.defaultParallelism, math.ceil(input_bytes / target_bytes))
    return min(MAX_SHUFFLE_PARTITIONS, n)


def job_session(spark: SparkSession, input_bytes: int | None,
                target_bytes: int = TARGET_SHUFFLE_INPUT_BYTES) -> SparkSession:
    """A session of the same application for one job, with shuffles sized from the bytes it reads.

    AQE merges small shuffle partitions and splits skewed join / large rebalance partitions, but never
    a partition of an aggregation or window shuffle (the dedup), nor a join whose partitions are all
    large, so the initial count must grow with the input.  The settings of ``spark`` are copied and
    it is left alone: flows side by side don't meet.  ``None``: the copied counts as they are.  Arrow
    batches are cut at ``ARROW_BATCH_BYTES``, so that Python workers' memory doesn't follow the input.
    """
    job = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key) and job.conf.get(key, None) != value:
            job.conf.set(key, value)
    job.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))
    if input_bytes:
        for key in _SHUFFLE_KEYS:
            job.conf.set(key, str(shuffle_partitions_for(spark, input_bytes, target_bytes)))
    return job
