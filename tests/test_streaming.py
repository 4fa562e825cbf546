"""Structured Streaming variant of bronze -> silver (file source + foreachBatch)."""

import os

from pyspark.sql import functions as F

from tierkit.plans.flows import SilverConfig
from tierkit.plans.watermark import read_watermark
from tierkit.sinks.files import land_json
from tierkit.sources.tables import read_table
from tierkit.streaming.incremental import stream_bronze_to_silver
from tierkit.workloads import RECORD_SCHEMA, SILVER_RULES

OLD = "20250710_000000_000000"
S1 = "20250711_080910_000111"
S2 = "20250712_101010_000001"


def _land(spark, root, stamp, rows):
    df = spark.createDataFrame(rows, "venue_key string, label string, nation string")
    land_json(df, root, stamp=stamp)


def test_stream_publishes_newest_and_skips_late(spark, tmpdir_path):
    cfg = SilverConfig(
        bronze_root=os.path.join(tmpdir_path, "bronze"),
        silver_path=os.path.join(tmpdir_path, "silver"),
        watermark_path=os.path.join(tmpdir_path, "wm"), record_schema=RECORD_SCHEMA,
        rules=SILVER_RULES, key="venue_key", tie_break=[F.col("label")], partition_by=["nation"])
    ckpt = os.path.join(tmpdir_path, "ckpt")

    def ids():
        return sorted((r.venue_key, r.label) for r in read_table(spark, cfg.silver_path).collect())

    _land(spark, cfg.bronze_root, S1, [("a", "one", "AT"), ("a", "two", "AT")])
    stream_bronze_to_silver(spark, cfg, ckpt)
    assert ids() == [("a", "one")]
    assert read_watermark(spark, cfg.watermark_path) == S1

    _land(spark, cfg.bronze_root, S2, [("b", "three", "DE")])
    stream_bronze_to_silver(spark, cfg, ckpt)
    assert ids() == [("b", "three")]

    _land(spark, cfg.bronze_root, OLD, [("z", "late", "FR")])
    stream_bronze_to_silver(spark, cfg, ckpt)
    assert ids() == [("b", "three")]
    assert read_watermark(spark, cfg.watermark_path) == S2


def test_stream_file_name_layout(spark, tmpdir_path):
    import json

    root = os.path.join(tmpdir_path, "bronze")

    def write(day, stamp, recs):
        d = os.path.join(root, "year=2025", "month=07", f"day={day}")
        os.makedirs(d, exist_ok=True)
        with open(os.path.join(d, f"venues_{stamp}.json"), "w", encoding="utf-8") as f:
            f.writelines(json.dumps(r) + "\n" for r in recs)

    cfg = SilverConfig(
        bronze_root=root, silver_path=os.path.join(tmpdir_path, "silver"),
        watermark_path=os.path.join(tmpdir_path, "wm"), record_schema=RECORD_SCHEMA,
        rules=SILVER_RULES, key="venue_key", tie_break=[F.col("label")], partition_by=["nation"], layout="file_name")
    ckpt = os.path.join(tmpdir_path, "ckpt")
    write("11", S1, [{"venue_key": "a", "label": "one"}, {"venue_key": "a", "label": "two"}])
    write("12", S2, [{"venue_key": "b", "label": "three"}])
    with open(os.path.join(root, "year=2025", "month=07", "day=12", "venues_latest.json"),
              "w") as f:
        f.write(json.dumps({"venue_key": "zzz", "label": "no stamp"}) + "\n")
    stream_bronze_to_silver(spark, cfg, ckpt)
    rows = read_table(spark, cfg.silver_path).collect()
    assert sorted((r.venue_key, r.label, r.snapshot_stamp) for r in rows) == [("b", "three", S2)]
    assert read_watermark(spark, cfg.watermark_path) == S2


def test_stream_never_sees_half_a_snapshot(spark, tmpdir_path):
    """Files that arrive without their commit row are not published; a second landing is refused."""
    import pytest

    cfg = SilverConfig(
        bronze_root=os.path.join(tmpdir_path, "bronze"), silver_path=os.path.join(tmpdir_path, "silver"),
        watermark_path=os.path.join(tmpdir_path, "wm"), record_schema=RECORD_SCHEMA,
        rules=SILVER_RULES, key="venue_key", tie_break=[F.col("label")], partition_by=["nation"])
    ckpt = os.path.join(tmpdir_path, "ckpt")
    _land(spark, cfg.bronze_root, S1, [("a", "one", "AT"), ("b", "two", "AT")])
    half = spark.createDataFrame([("c", "three", "AT")], "venue_key string, label string, nation string")
    half.write.json(f"{cfg.bronze_root}/year=2025/month=07/day=12/snapshot={S2}")
    stream_bronze_to_silver(spark, cfg, ckpt)
    assert sorted(r.venue_key for r in read_table(spark, cfg.silver_path).collect()) == ["a", "b"]
    with pytest.raises(ValueError, match="committed already"):
        _land(spark, cfg.bronze_root, S1, [("d", "late", "AT")])
    with pytest.raises(ValueError, match="never committed"):
        _land(spark, cfg.bronze_root, S2, [("d", "late", "AT")])
