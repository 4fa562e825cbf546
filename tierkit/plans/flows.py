"""Landing, bronze -> silver, silver -> gold, and the three in order.

Design points (compared with a straight "SQL per step" job):

* The newest snapshot is the newest *committed* one (a landing commits after its
  write), read from its folder alone: bronze is not listed, and a snapshot
  whose files are still arriving is not seen.
* Each result is written once as a new version and *read back* for the CSV
  mirror and the ``MAX`` stamp: no step recomputes the deduplication, the
  mirror always equals the table, and the lineage is cut at the table.
* Nothing is written when there is nothing new.  Table, mirror and stamp are
  replaced together by creating one pointer file after their write: a crash
  between any two steps leaves a matching set, and the watermark row that may be
  missing after it is written by the next run (``published_watermark``).
* A flow runs in a session of its own for its shuffle sizes; the caller's
  settings are not touched.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tierkit.operators.aggregate import audit_columns, group_count
from tierkit.operators.dedup import first_per_key
from tierkit.operators.enrich import enrich_left
from tierkit.operators.guards import is_empty
from tierkit.operators.project import apply_rules
from tierkit.control import fresh_name
from tierkit.functions.stamps import default_stamp
from tierkit.plans.watermark import compact_watermark, published_watermark, write_watermark
from tierkit.session import job_session
from tierkit.sinks.commits import compact_commits
from tierkit.sinks.files import land_json, publish
from tierkit.sinks.layout import clustered
from tierkit.sources.snapshots import Snapshot, newest_snapshot, read_snapshots
from tierkit.sources.tables import read_table, table_bytes

@dataclass
class Enrichment:
    """J2 inside the silver step: ``attrs`` of ``reference`` by the silver columns ``keys``."""

    reference: DataFrame
    keys: list
    attrs: list


@dataclass
class SilverConfig:
    bronze_root: str
    silver_path: str
    watermark_path: str
    record_schema: object              # StructType or DDL of one raw record
    rules: dict                        # output column -> rule spec (see project.py)
    key: str
    tie_break: list                    # Columns that settle ties inside a snapshot
    partition_by: list = field(default_factory=list)
    csv_path: str | None = None
    layout: str = "directory"
    stamp_col: str = "snapshot_stamp"
    fmt: str = "parquet"
    enrich: Enrichment | None = None
    corrupt_path: str | None = None    # lines that are no records go here; else they fail the run


@dataclass
class GoldConfig:
    silver_path: str
    gold_path: str
    watermark_path: str
    keys: list
    count_col: str
    count_alias: str
    csv_path: str | None = None
    stamp_col: str = "snapshot_stamp"
    fmt: str = "parquet"
    skip_if_current: bool = False
    text_partitions: tuple = ()        # silver's partition columns that hold text


def land_snapshot(df: DataFrame, bronze_root: str, watermark_path: str | None = None,
                  stamp: str | None = None) -> str:
    """Land one snapshot as NDJSON (no records: an error) and commit the bronze watermark."""
    stamp = land_json(df, bronze_root, stamp)
    if watermark_path:
        write_watermark(df.sparkSession, watermark_path, stamp)
    return stamp


def silver_frame(scan: DataFrame, cfg: SilverConfig, newest: str) -> DataFrame:
    """The silver rows of snapshot ``newest``: W1/F2, P1, and J2 where configured."""
    snap = scan.where(F.col(cfg.stamp_col) == F.lit(newest))
    dedup = first_per_key(snap, [cfg.key], order=[F.col(cfg.stamp_col).desc()],
                          tie_break=cfg.tie_break)
    spec = dict(cfg.rules)
    spec.setdefault(cfg.stamp_col, "keep")
    out = apply_rules(dedup, spec)
    return enrich_left(out, cfg.enrich.reference, cfg.enrich.keys, cfg.enrich.attrs) if cfg.enrich else out


def bronze_to_silver(spark: SparkSession, cfg: SilverConfig) -> dict:
    """Newest unseen snapshot -> deduplicated, cleaned silver table."""
    since = default_stamp(published_watermark(spark, cfg.watermark_path, cfg.silver_path))
    snap = newest_snapshot(spark, cfg.bronze_root, since, cfg.layout)
    if snap.stamp is None:
        return {"status": "nothing_new", "since": since}
    return dict(publish_snapshot(spark, cfg, snap), since=since)


def publish_snapshot(spark: SparkSession, cfg: SilverConfig, snap: Snapshot) -> dict:
    """Write silver for ``snap``, its CSV mirror, then commit the watermark.

    Idempotent: a re-run writes the same table.  Lines that are no records fail
    the run before anything is replaced, or go to ``cfg.corrupt_path``.
    """
    job = job_session(spark, snap.bytes)
    fields = StructType.fromDDL(cfg.record_schema) if isinstance(cfg.record_schema, str) else cfg.record_schema
    divert = fresh_name([*fields.fieldNames(), cfg.stamp_col], "__corrupt") if cfg.corrupt_path else None
    scan = read_snapshots(job, cfg.bronze_root, cfg.record_schema, layout=cfg.layout,
                          stamp_col=cfg.stamp_col, folders=snap.folders, corrupt_col=divert)
    out = {"status": "written", "stamp": snap.stamp}
    if divert:
        own = scan.where(F.col(cfg.stamp_col) == F.lit(snap.stamp))
        bad = own.where(F.col(divert).isNotNull())
        bad.select(F.col(cfg.stamp_col), F.col(divert).alias("line")).write.mode("overwrite").parquet(
            f"{cfg.corrupt_path}/{snap.stamp}")
        out["corrupt"] = job.read.parquet(f"{cfg.corrupt_path}/{snap.stamp}").count()
        scan = scan.where(F.col(divert).isNull()).drop(divert)
    # dedup keeps >= 1 row per key and the projection drops none, so the silver rows are empty
    # exactly when the snapshot is - a LIMIT 1 scan instead of a second run of the dedup shuffle.
    if is_empty(scan.where(F.col(cfg.stamp_col) == F.lit(snap.stamp))):
        return dict(out, status="empty")
    silver = silver_frame(scan, cfg, snap.stamp)
    publish(silver, cfg.silver_path, cfg.partition_by, cfg.fmt, cfg.csv_path, snap.stamp)
    write_watermark(spark, cfg.watermark_path, snap.stamp)
    return out


def gold_frame(silver: DataFrame, cfg: GoldConfig, as_of) -> DataFrame:
    """A3 + X8 over the silver table."""
    return audit_columns(group_count(silver, cfg.keys, cfg.count_col, cfg.count_alias), as_of)


def silver_to_gold(spark: SparkSession, cfg: GoldConfig, as_of: datetime | None = None) -> dict:
    """Silver table -> gold aggregate, clustered by its keys, with CSV mirror."""
    job = job_session(spark, table_bytes(spark, cfg.silver_path))
    silver = read_table(job, cfg.silver_path, cfg.fmt, text_partitions=cfg.text_partitions)
    # F4 + A2 in one job: the MAX scans the stamp column anyway, the count of
    # the same rows comes with it
    stats = silver.agg(F.max(cfg.stamp_col).alias("m"), F.count(F.lit(1)).alias("n")).first()
    if stats["n"] == 0:
        return {"status": "empty"}
    newest = stats["m"]
    if cfg.skip_if_current and newest is not None and newest == published_watermark(
            spark, cfg.watermark_path, cfg.gold_path):
        return {"status": "current", "stamp": newest}
    as_of = as_of or datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0)
    gold = gold_frame(silver, cfg, as_of)
    # K4 + K5 in one write: the range sample and the write share the aggregate's shuffle
    publish(clustered(gold, cfg.keys), cfg.gold_path, fmt=cfg.fmt, csv_path=cfg.csv_path, stamp=newest or "")
    if newest:
        write_watermark(spark, cfg.watermark_path, newest)
    return {"status": "written", "stamp": newest, "as_of": as_of}


def run_all(spark: SparkSession, records: DataFrame | None, bronze_watermark: str | None,
            silver_cfg: SilverConfig, gold_cfg: GoldConfig, as_of=None,
            watermark_max_files: int = 64, stamp: str | None = None) -> dict:
    """C4: land (when records are given) -> silver -> gold; a failure stops the rest.

    Last, the layers' watermark datasets and bronze's commit rows are compacted once they hold more
    than ``watermark_max_files`` commit files (one listing each; small jobs when due).
    """
    out = {}
    if records is not None:
        out["landed"] = land_snapshot(records, silver_cfg.bronze_root, bronze_watermark, stamp)
    out["silver"] = bronze_to_silver(spark, silver_cfg)
    out["gold"] = silver_to_gold(spark, gold_cfg, as_of)
    for wm in (bronze_watermark, silver_cfg.watermark_path, gold_cfg.watermark_path):
        if wm:
            compact_watermark(spark, wm, watermark_max_files)
    compact_commits(spark, silver_cfg.bronze_root, watermark_max_files)
    return out
