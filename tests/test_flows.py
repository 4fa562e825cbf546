"""C1-C4, S2/S3/F5, J1/W1/F2, S7/S8/K7 on the snapshot fixture of FIXTURES.md."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tierkit.functions.stamps import EPOCH_STAMP, default_stamp
from tierkit.plans.flows import GoldConfig, SilverConfig, bronze_to_silver, silver_to_gold
from tierkit.plans.watermark import compact_watermark, effective_watermark, read_watermark, \
    write_watermark
from tierkit.session import job_session, shuffle_partitions_for
from tierkit.sinks.files import export_csv, land_json, overwrite_table
from tierkit.sinks.versions import current_path
from tierkit.sources.snapshots import day_folders, newest_snapshot, read_snapshots
from tierkit.sources.tables import read_table
from tierkit.workloads import AS_OF, RECORD_SCHEMA, SILVER_RULES

S1 = "20250711_080910_000111"
S2 = "20250712_101010_000001"
S3 = "20250713_000000_000000"


def _write(root, day, name, recs):
    d = os.path.join(root, "year=2025", "month=07", f"day={day}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w", encoding="utf-8") as f:
        for r in recs:
            f.write(json.dumps(r, ensure_ascii=False) + "\n")


def _bronze(root):
    _write(root, "11", f"venues_{S1}.json", [
        {"venue_key": "a", "label": " X ", "nation": "Austria", "amount": "1.5"},
        {"venue_key": "old", "label": "gone", "nation": "Austria", "amount": ""},
    ])
    _write(root, "12", f"venues_{S2}.json", [
        {"venue_key": "a", "label": "first", "nation": "South Korea", "amount": "1.5"},
        {"venue_key": "a", "label": "second", "nation": "South Korea", "amount": "2"},
        {"venue_key": " a", "label": "third", "nation": "", "amount": "3"},
        {"venue_key": None, "label": "n1", "nation": None, "amount": "x"},
        {"venue_key": None, "label": "n2", "nation": None, "amount": ""},
    ])
    _write(root, "12", "venues_latest.json", [{"venue_key": "zzz", "label": "no stamp"}])


def _cfg(base):
    return SilverConfig(
        bronze_root=os.path.join(base, "bronze"), silver_path=os.path.join(base, "silver"),
        watermark_path=os.path.join(base, "silver_wm"), record_schema=RECORD_SCHEMA,
        rules=SILVER_RULES, key="venue_key", tie_break=[F.col("label")], partition_by=["nation"],
        csv_path=os.path.join(base, "silver_csv"), layout="file_name")


def _files(path):
    out = {}
    for d, _, fs in os.walk(path):
        for f in fs:
            p = os.path.join(d, f)
            out[p] = os.stat(p).st_mtime_ns
    return out


def test_scan_file_name_layout(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "bronze")
    _bronze(root)
    df = read_snapshots(spark, root, RECORD_SCHEMA, layout="file_name")
    rows = df.select("venue_key", "snapshot_stamp").collect()
    stamps = {r.venue_key: r.snapshot_stamp for r in rows}
    assert stamps["old"] == S1 and stamps["zzz"] == ""
    newer = df.where(F.col("snapshot_stamp") > S1)
    assert newer.count() == 5
    # the file-name filter prunes files before they are read
    qe = newer._jdf.queryExecution()
    qe.toRdd().count()
    scan = qe.executedPlan().collectLeaves().head()
    assert scan.metrics().apply("numFiles").value() == 1


def test_newest_snapshot_of_the_file_name_layout(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "bronze")
    _bronze(root)
    stamp, folders, size = newest_snapshot(spark, root, S1, "file_name")
    assert stamp == S2 and [f.rsplit("/", 1)[-1] for f in folders] == ["day=12"]
    assert size == os.path.getsize(os.path.join(root, "year=2025", "month=07", "day=12", f"venues_{S2}.json"))
    # only folders from the watermark's day on are listed
    assert [f.rsplit("/", 1)[-1] for f in day_folders(spark, root, "*/*/*", S2)] == ["day=12"]
    assert len(day_folders(spark, root, "*/*/*")) == 2
    narrowed = read_snapshots(spark, root, RECORD_SCHEMA, layout="file_name", folders=folders)
    # the day folder also holds the unstamped file; its stamp is '' as before
    assert sorted(r.snapshot_stamp for r in narrowed.select("snapshot_stamp").collect()) == ["", S2, S2, S2, S2, S2]
    assert newest_snapshot(spark, root, S2, "file_name") == (None, [], None)


def test_newest_snapshot_is_the_newest_commit(spark, tmpdir_path):
    droot = os.path.join(tmpdir_path, "landed")
    assert newest_snapshot(spark, droot) == (None, [], None)
    recs = spark.createDataFrame([("a", S1), ("b", S2), ("c", S2)], "id string, stamp string")
    land_json(recs, droot, stamp_col="stamp")
    spark.createDataFrame([("d",)], "id string").write.json(f"{droot}/year=2025/month=07/day=13/snapshot={S3}")
    stamp, folders, size = newest_snapshot(spark, droot)  # S3 was never committed
    assert stamp == S2 and len(folders) == 1 and size > 0 and folders[0].endswith(f"day=12/snapshot={S2}")
    assert newest_snapshot(spark, droot, S2).stamp is None
    got = read_snapshots(spark, droot, "id string", folders=folders)
    assert sorted((r.id, r.snapshot, r.day) for r in got.collect()) == [("b", S2, "12"), ("c", S2, "12")]
    # the scan lists and opens only the newest snapshot's files
    files = got.inputFiles()
    assert files and all(f"/snapshot={S2}/" in f for f in files)
    commits = spark.read.parquet(f"{droot}/_commits").collect()
    assert sorted((r.stamp, r.rows) for r in commits) == [(S1, 1), (S2, 2)]
    with pytest.raises(ValueError, match="committed already"):
        land_json(recs.where("id = 'a'"), droot, stamp_col="stamp")
    with pytest.raises(ValueError, match="no stamps"):
        land_json(recs.withColumn("stamp", F.lit("soon")), droot, stamp_col="stamp")
    with pytest.raises(ValueError, match="no records"):
        land_json(recs.where("false").drop("stamp"), droot, stamp=S3[:-1] + "7")


def test_two_step_landing_is_refused(spark, tmpdir_path):
    cfg = _cfg(tmpdir_path)
    cfg.layout = "directory"
    two = spark.createDataFrame([("a", "x", "AT"), ("b", "y", "AT")], "venue_key string, label string, nation string")
    land_json(two, cfg.bronze_root, stamp=S1)
    assert bronze_to_silver(spark, cfg)["status"] == "written"
    with pytest.raises(ValueError, match="committed already"):
        land_json(two.limit(1), cfg.bronze_root, stamp=S1)
    assert bronze_to_silver(spark, cfg)["status"] == "nothing_new"
    assert read_table(spark, cfg.silver_path).count() == 2


def test_job_session_leaves_the_callers_settings(spark):
    before = dict(spark.conf.getAll)
    a, b = job_session(spark, 1000 * (256 << 20)), job_session(spark, 50 * (256 << 20))
    for s, n in ((a, "1000"), (b, "50")):
        assert s.conf.get("spark.sql.shuffle.partitions") == n
        assert s.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum") == n
        assert s.conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")
    assert dict(spark.conf.getAll) == before
    assert shuffle_partitions_for(spark, 1) == spark.sparkContext.defaultParallelism
    assert shuffle_partitions_for(spark, 100 << 40) == 20_000
    assert job_session(spark, None).conf.get("spark.sql.shuffle.partitions") == before["spark.sql.shuffle.partitions"]


def _failing(df):
    """``df`` with a column that fails in the write stage."""
    return df.withColumn("boom", F.when(F.col("v") >= 0, F.raise_error(F.lit("boom"))).cast("int"))


@pytest.mark.parametrize("parts", [[], ["p"]])
@pytest.mark.parametrize("write", [overwrite_table, export_csv])
def test_failed_write_leaves_the_dataset(spark, tmpdir_path, parts, write):
    path = os.path.join(tmpdir_path, "t")
    df = spark.range(1000).select(F.col("id").alias("v"), (F.col("id") % 3).cast("string").alias("p"))
    write(df, path, parts)
    before = current_path(spark, path)
    with pytest.raises(Exception, match="boom"):
        write(_failing(df), path, parts)
    assert current_path(spark, path) == before
    reader = spark.read.option("header", True)
    assert (reader.csv(before) if write is export_csv else reader.parquet(before)).count() == 1000


def test_failed_silver_write_keeps_table_mirror_and_watermark(spark, tmpdir_path):
    cfg = _cfg(tmpdir_path)
    _bronze(cfg.bronze_root)
    bronze_to_silver(spark, cfg)
    table, mirror = current_path(spark, cfg.silver_path), current_path(spark, cfg.csv_path)
    _write(cfg.bronze_root, "13", f"venues_{S3}.json", [{"venue_key": "b", "label": "new"}])
    with open(os.path.join(cfg.bronze_root, "year=2025", "month=07", "day=13", f"venues_{S3}.json"), "a") as f:
        f.write('{"venue_key": "c", "lab\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        bronze_to_silver(spark, cfg)
    assert (current_path(spark, cfg.silver_path), current_path(spark, cfg.csv_path)) == (table, mirror)
    assert read_watermark(spark, cfg.watermark_path) == S2
    cfg.corrupt_path = os.path.join(tmpdir_path, "corrupt")
    out = bronze_to_silver(spark, cfg)
    assert out["status"] == "written" and out["corrupt"] == 1
    assert [r.line for r in spark.read.parquet(f"{cfg.corrupt_path}/{S3}").collect()] == ['{"venue_key": "c", "lab']
    assert [r.venue_key for r in read_table(spark, cfg.silver_path).collect()] == ["b"]


def test_old_versions_go_after_the_commit(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t")
    for n in range(20):
        overwrite_table(spark.range(n), path)
        assert read_table(spark, path).count() == n
    assert len(os.listdir(os.path.join(path, "_versions"))) == 2
    # a table may be computed from itself
    overwrite_table(read_table(spark, path).where("id < 5"), path)
    assert read_table(spark, path).count() == 5


def test_stamps_are_utc_in_any_session(spark):
    from datetime import datetime, timezone

    from tierkit.functions.stamps import stamp_format
    from tierkit.session import job_session as session_of

    job = session_of(spark, None)
    instants = [datetime(2025, 1, 1, tzinfo=timezone.utc), datetime(2018, 11, 4, 3, 30, 0, 123, tzinfo=timezone.utc),
                datetime(2018, 2, 18, 1, 59, 59, 999999, tzinfo=timezone.utc), datetime(1969, 12, 31, 23, 0, 0, 5, tzinfo=timezone.utc)]
    since = [t - datetime(1970, 1, 1, tzinfo=timezone.utc) for t in instants]
    micros = [(d.days * 86400 + d.seconds) * 1_000_000 + d.microseconds for d in since]
    want = [t.strftime("%Y%m%d_%H%M%S_%f") for t in instants]
    for zone in ("UTC", "America/Sao_Paulo", "Asia/Kolkata"):
        job.conf.set("spark.sql.session.timeZone", zone)
        df = job.createDataFrame([(m,) for m in micros], "m long")
        with_zone = df.select(stamp_format(F.timestamp_micros("m")).alias("s"))
        assert [r.s for r in with_zone.collect()] == want
        plain = job.createDataFrame([(t.replace(tzinfo=None).isoformat(sep=" "),) for t in instants], "t string")
        assert [r.s for r in plain.select(stamp_format(F.col("t").cast("timestamp_ntz")).alias("s")).collect()] == want


def test_bronze_to_silver_then_gold(spark, tmpdir_path):
    cfg = _cfg(tmpdir_path)
    _bronze(cfg.bronze_root)
    assert read_watermark(spark, cfg.watermark_path) is None
    assert effective_watermark(spark, cfg.watermark_path) == EPOCH_STAMP
    res = bronze_to_silver(spark, cfg)
    assert res["status"] == "written" and res["stamp"] == S2
    silver = read_table(spark, cfg.silver_path)
    rows = sorted(silver.select("venue_key", "label", "nation", "amount").collect(),
                  key=lambda r: r.label)
    assert [r.label for r in rows] == ["first", "n1", "third"]
    assert [r.venue_key for r in rows] == ["a", None, "a"]
    assert [r.nation for r in rows] == ["south_korea", "unknown", "unknown"]
    assert [r.amount for r in rows] == [1.5, None, 3.0]
    assert read_watermark(spark, cfg.watermark_path) == S2
    # CSV mirror equals the table
    csv = spark.read.option("header", True).csv(current_path(spark, cfg.csv_path))
    assert csv.count() == 3

    # nothing new: no file is touched
    before = _files(tmpdir_path)
    assert bronze_to_silver(spark, cfg)["status"] == "nothing_new"
    assert _files(tmpdir_path) == before

    gcfg = GoldConfig(keys=["nation", "kind"], count_col="venue_key", count_alias="n", silver_path=cfg.silver_path, gold_path=os.path.join(tmpdir_path, "gold"),
                      watermark_path=os.path.join(tmpdir_path, "gold_wm"),
                      csv_path=os.path.join(tmpdir_path, "gold_csv"))
    assert silver_to_gold(spark, gcfg, as_of=AS_OF)["status"] == "written"
    gold = {(r.nation, r.kind): r.n for r in read_table(spark, gcfg.gold_path).collect()}
    # kind absent from the records: NULL forms its own group
    assert gold == {("south_korea", None): 1, ("unknown", None): 1}
    g = read_table(spark, gcfg.gold_path).select("created_at", "updated_at").distinct().collect()
    assert len(g) == 1 and g[0].created_at == g[0].updated_at
    assert read_watermark(spark, gcfg.watermark_path) == S2


def test_two_unseen_snapshots_keep_newest_only(spark, tmpdir_path):
    cfg = _cfg(tmpdir_path)
    _bronze(cfg.bronze_root)
    _write(cfg.bronze_root, "13", f"venues_{S3}.json", [{"venue_key": "b", "label": "new"}])
    bronze_to_silver(spark, cfg)
    assert [r.venue_key for r in read_table(spark, cfg.silver_path).collect()] == ["b"]
    assert read_watermark(spark, cfg.watermark_path) == S3


def test_watermark_at_newest_gives_nothing(spark, tmpdir_path):
    cfg = _cfg(tmpdir_path)
    _bronze(cfg.bronze_root)
    write_watermark(spark, cfg.watermark_path, S2)
    assert bronze_to_silver(spark, cfg)["status"] == "nothing_new"
    assert not os.path.exists(cfg.silver_path)


def test_rerun_is_idempotent(spark, tmpdir_path):
    cfg = _cfg(tmpdir_path)
    _bronze(cfg.bronze_root)
    bronze_to_silver(spark, cfg)
    first = sorted(map(repr, read_table(spark, cfg.silver_path).collect()))
    from tierkit.plans.watermark import reset_watermark
    reset_watermark(spark, cfg.watermark_path, EPOCH_STAMP)
    bronze_to_silver(spark, cfg)
    assert sorted(map(repr, read_table(spark, cfg.silver_path).collect())) == first


def test_watermark_default_and_monotonic(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "wm")
    assert default_stamp(None) == EPOCH_STAMP and default_stamp("  ") == EPOCH_STAMP
    write_watermark(spark, p, S2)
    write_watermark(spark, p, S1)
    assert read_watermark(spark, p) == S2
    with pytest.raises(ValueError):
        write_watermark(spark, p, " ")


def test_run_all_lands_then_silver_then_gold(spark, tmpdir_path):
    from tierkit.plans.flows import run_all

    cfg = _cfg(tmpdir_path)
    cfg.layout = "directory"
    gcfg = GoldConfig(keys=["nation", "kind"], count_col="venue_key", count_alias="n", silver_path=cfg.silver_path, gold_path=os.path.join(tmpdir_path, "gold"),
                      watermark_path=os.path.join(tmpdir_path, "gold_wm"))
    recs = spark.createDataFrame([("a", "x", "AT", "micro"), ("a", "y", "AT", "micro"),
                                  ("b", "z", "DE", "brewpub")],
                                 "venue_key string, label string, nation string, kind string")
    bronze_wm = os.path.join(tmpdir_path, "bronze_wm")
    out = run_all(spark, recs, bronze_wm, cfg, gcfg, as_of=AS_OF)
    assert out["silver"]["status"] == "written" and out["gold"]["status"] == "written"
    assert read_watermark(spark, bronze_wm) == out["landed"]
    gold = {(r.nation, r.kind): r.n for r in read_table(spark, gcfg.gold_path).collect()}
    assert gold == {("at", "micro"): 1, ("de", "brewpub"): 1}


def test_run_all_failure_stops_the_rest(spark, tmpdir_path):
    from tierkit.plans.flows import run_all

    cfg = _cfg(tmpdir_path)
    cfg.layout = "directory"
    cfg.rules = {**SILVER_RULES, "nation": "no such rule"}
    gcfg = GoldConfig(keys=["nation", "kind"], count_col="venue_key", count_alias="n", silver_path=cfg.silver_path,
                      gold_path=os.path.join(tmpdir_path, "gold"), watermark_path=os.path.join(tmpdir_path, "gold_wm"))
    recs = spark.createDataFrame([("a", "x", "AT")], "venue_key string, label string, nation string")
    with pytest.raises(ValueError):
        run_all(spark, recs, None, cfg, gcfg)
    assert not os.path.exists(gcfg.gold_path) and not os.path.exists(cfg.silver_path)
    assert read_watermark(spark, cfg.watermark_path) is None


def test_compact_watermark_keeps_the_max(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "wm")
    assert compact_watermark(spark, path) is False  # nothing written yet
    for stamp in (S1, S3, S2, S1):
        write_watermark(spark, path, stamp)

    def files():
        return [f for f in os.listdir(path) if f.endswith(".parquet")]

    assert len(files()) == 4
    assert compact_watermark(spark, path, max_files=8) is False
    assert compact_watermark(spark, path, max_files=3) is True
    assert len(files()) == 1 and read_watermark(spark, path) == S3
    # a crash between the append and the removal of older files: nothing is lost
    write_watermark(spark, path, S3)
    assert read_watermark(spark, path) == S3
    write_watermark(spark, path, S2)  # older than the max: never moves it back
    assert read_watermark(spark, path) == S3


def test_job_session_sizes_the_dedup_exchange(spark, tmpdir_path):
    import re

    from tierkit.plans.flows import silver_frame

    root = os.path.join(tmpdir_path, "bronze")
    _bronze(root)
    cfg = _cfg(tmpdir_path)

    def exchange_partitions(session):
        scan = read_snapshots(session, root, RECORD_SCHEMA, layout="file_name")
        plan = silver_frame(scan, cfg, S2)._jdf.queryExecution().executedPlan().toString()
        return int(re.search(r"Exchange hashpartitioning\(__k0#\d+, (\d+)\)", plan).group(1))

    assert exchange_partitions(job_session(spark, 24 * (256 << 20))) == 24
    assert exchange_partitions(spark) == int(spark.conf.get("spark.sql.shuffle.partitions"))
