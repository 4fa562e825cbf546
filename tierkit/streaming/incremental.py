"""Bronze -> silver driven by Structured Streaming's file source.

The batch flow finds new snapshots by comparing stamps with a stored
watermark.  Here the streaming file source does the bookkeeping instead: its
checkpoint records which files were already seen, so each trigger delivers
only what arrived since - exactly once, also after a driver or executor
failure.

* ``directory`` layout: the stream reads the landing's commit rows, one per
  landed snapshot.  A snapshot whose files are still arriving has no such row
  yet, so whatever the trigger only whole snapshots are published.
* ``file_name`` layout: the stream reads the listing of new files (the
  ``binaryFile`` source with only ``path`` and ``length``; nothing is opened).
  A snapshot is one file there, complete as soon as it appears.

Every micro-batch finds its newest stamp above the committed silver watermark (a
late, older snapshot never replaces a newer one) and publishes that snapshot
from its folder.

Run it with ``available_now=True`` after each landing (drains what is there,
then stops) or with a processing-time trigger as a long-running job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierkit.plans.flows import SilverConfig, publish_snapshot
from tierkit.functions.stamps import default_stamp
from tierkit.plans.watermark import published_watermark
from tierkit.sinks.commits import COMMIT_SCHEMA, commits_path
from tierkit.sources.snapshots import BINARY_FILE_SCHEMA, listing_columns, newest_of, \
    newest_snapshot


def stream_bronze_to_silver(spark: SparkSession, cfg: SilverConfig, checkpoint: str,
                            available_now: bool = True, processing_time: str | None = None,
                            max_files_per_trigger: int | None = None, glob: str = "*/*/*/*.json"):
    """Start the incremental silver stream; waits for it when ``available_now``.

    Both landing layouts are read (``cfg.layout``).  Returns the
    ``StreamingQuery``.
    """
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if cfg.layout == "directory":
        arrivals = reader.schema(COMMIT_SCHEMA).parquet(commits_path(cfg.bronze_root))
    else:
        arrivals = reader.format("binaryFile").schema(BINARY_FILE_SCHEMA).load(
            f"{cfg.bronze_root.rstrip('/')}/{glob}").select(*listing_columns())

    def publish(batch: DataFrame, epoch_id: int) -> None:
        since = default_stamp(published_watermark(spark, cfg.watermark_path, cfg.silver_path))
        # the batch only says that something landed: a compacted commit row may be newer than its files
        snap = (newest_snapshot(spark, cfg.bronze_root, since) if cfg.layout == "directory"
                else newest_of(batch, since))
        if snap.stamp is not None:
            publish_snapshot(spark, cfg, snap)

    w = arrivals.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    query = w.start()
    if available_now:
        query.awaitTermination()
    return query
