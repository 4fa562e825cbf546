"""Landings, set commits, orphans and compaction under crashes, side by side and beneath odd paths."""

import os
import shutil
import threading

import pytest
from pyspark.sql import functions as F

from tierkit import control
from tierkit.functions.stamps import EPOCH_STAMP
from tierkit.plans import flows
from tierkit.plans.flows import GoldConfig, SilverConfig, bronze_to_silver, land_snapshot, silver_to_gold
from tierkit.plans.watermark import compact_watermark, published_watermark, read_watermark, reset_watermark, write_watermark
from tierkit.sinks import files, versions
from tierkit.sinks.commits import COMMIT_SCHEMA, append_commits, commits_path, committed_among, compact_commits, kept_path, newest_commit
from tierkit.sinks.files import LeftoverError, export_csv, land_json, overwrite_table, publish, recover_landings
from tierkit.sinks.versions import current_commit, current_path, replace_dataset, replace_set, vacuum
from tierkit.sources.snapshots import newest_snapshot, read_snapshots
from tierkit.sources.tables import read_table
from tierkit.workloads import RECORD_SCHEMA, SILVER_RULES

A, B = "20240305_101112_000001", "20240306_101112_000002"
FOLDER = "year=2024/month=03/day=05/snapshot=" + A


class Crash(BaseException):
    """Stands for a killed driver: no handler of ``Exception`` sees it."""


def _records(spark, n=3, stamp=None):
    df = spark.range(n).select(F.col("id").cast("string").alias("id"))
    return df.withColumn("stamp", F.lit(stamp)) if stamp else df


def _crashed(monkeypatch, spark, root, stamp_col):
    """A landing whose driver was killed between the move and the commit: no clean-up ran."""
    def killed(*a):
        raise Crash

    with monkeypatch.context() as m:
        m.setattr(files, "append_commits", killed)
        m.setattr(files, "delete_path", lambda *a: None)
        with pytest.raises(Crash):
            land_json(_records(spark, 2, A if stamp_col else None), root, None if stamp_col else A, "stamp" if stamp_col else None)
    assert os.path.isdir(f"{root}/{FOLDER}") and newest_snapshot(spark, root).stamp is None


@pytest.mark.parametrize("stamp_col", [False, True])
def test_leftovers_of_a_crashed_landing_are_refused_or_replaced(spark, tmpdir_path, monkeypatch, stamp_col):
    root = os.path.join(tmpdir_path, "bronze dir%20")
    _crashed(monkeypatch, spark, root, stamp_col)
    how = {"stamp_col": "stamp"} if stamp_col else {"stamp": A}
    again = _records(spark, 3, A if stamp_col else None)
    with pytest.raises(LeftoverError):
        land_json(again, root, **how)
    land_json(again, root, leftover="replace", **how)
    snap = newest_snapshot(spark, root)
    rows = read_snapshots(spark, root, "id string", folders=snap.folders).count()
    assert snap.stamp == A and rows == 3 == spark.read.parquet(commits_path(root)).first()["rows"]
    assert os.listdir(f"{root}/_claims") == [] and os.listdir(f"{root}/_staging") in ([], os.listdir(f"{root}/_staging")[:1])


@pytest.mark.parametrize("stamp_col", [False, True])
def test_files_that_were_there_before_never_join_a_landing(spark, tmpdir_path, stamp_col):
    root = os.path.join(tmpdir_path, "bronze")
    os.makedirs(f"{root}/{FOLDER}")
    with open(f"{root}/{FOLDER}/part-old.json", "w") as f:
        f.write('{"id":"old"}\n')
    how = {"stamp_col": "stamp"} if stamp_col else {"stamp": A}
    df = _records(spark, 2, A if stamp_col else None)
    with pytest.raises(LeftoverError):
        land_json(df, root, **how)
    assert newest_snapshot(spark, root).stamp is None and not os.listdir(f"{root}/_staging")
    land_json(df, root, leftover="replace", **how)
    got = read_snapshots(spark, root, "id string", folders=newest_snapshot(spark, root).folders)
    assert sorted(r.id for r in got.collect()) == ["0", "1"]


def test_recover_landings_clears_what_is_old(spark, tmpdir_path, monkeypatch):
    root = os.path.join(tmpdir_path, "bronze")
    _crashed(monkeypatch, spark, root, False)
    assert recover_landings(spark, root) == []  # it may still run
    assert recover_landings(spark, root, min_age_s=0) == [A]
    assert not os.path.exists(f"{root}/{FOLDER}") and not os.listdir(f"{root}/_staging")
    land_json(_records(spark), root, A)
    assert newest_snapshot(spark, root).stamp == A and recover_landings(spark, root, min_age_s=0) == []


def test_a_failed_landing_leaves_nothing(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "bronze")
    bad = _records(spark).withColumn("boom", F.when(F.col("id") == "1", F.raise_error(F.lit("boom"))).cast("int"))
    with pytest.raises(Exception, match="boom"):
        land_json(bad, root, A)
    with pytest.raises(ValueError, match="no stamps"):
        land_json(_records(spark).withColumn("stamp", F.when(F.col("id") > 0, A)), root, stamp_col="stamp")
    left = [f for d, _, fs in os.walk(root) for f in fs if not f.endswith(".crc")]
    assert left == []


def test_landings_side_by_side(spark, tmpdir_path):
    """Four at once: three of different stamps all land whole, of two at one stamp exactly one does."""
    root, errors = os.path.join(tmpdir_path, "bronze"), []
    stamps = [A, B, "20240307_101112_000003", A]

    def land(i):
        try:
            land_json(spark.range(500 + i).repartition(4).select(F.col("id").cast("string").alias("id")), root, stamps[i])
        except ValueError as e:
            errors.append(e)

    threads = [threading.Thread(target=land, args=(i,)) for i in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(errors) == 1
    commits = {r.stamp: r for r in spark.read.parquet(commits_path(root)).collect()}
    assert sorted(commits) == sorted(set(stamps))
    for stamp, c in commits.items():
        assert spark.read.text(f"{root}/{c.folder}").count() == c.rows in ([500, 503] if stamp == A else [500 + stamps.index(stamp)])


def _cfg(base):
    return SilverConfig(bronze_root=f"{base}/bronze", silver_path=f"{base}/silver", watermark_path=f"{base}/silver wm",
                        record_schema=RECORD_SCHEMA, rules=SILVER_RULES, key="venue_key", tie_break=[F.col("label")],
                        partition_by=["nation"], csv_path=f"{base}/silver_csv")


def _venues(spark, *keys):
    return spark.createDataFrame([(k, f"l{k}", "AT", "x") for k in keys], "venue_key string, label string, nation string, kind string")


def _state(spark, cfg):
    mirror = spark.read.option("header", True).csv(current_path(spark, cfg.csv_path))
    table = read_table(spark, cfg.silver_path)
    stamps = {r[0] for r in table.select("snapshot_stamp").distinct().collect()}
    return sorted(r.venue_key for r in table.collect()), sorted(r.venue_key for r in mirror.collect()), stamps


@pytest.mark.parametrize("step", range(6))
def test_a_crash_between_any_two_steps_leaves_a_matching_set(spark, tmpdir_path, monkeypatch, step):
    """Killed before the table, before the mirror, before the lock, before the pointer, before the watermark row, and
    after the pointer while old versions are removed."""
    cfg = _cfg(tmpdir_path)
    for stamp, keys in ((EPOCH_STAMP[:-1] + "1", "z"), (A, "ab")):
        land_snapshot(_venues(spark, *keys), cfg.bronze_root, None, stamp)
        assert bronze_to_silver(spark, cfg)["status"] == "written"
    before = _state(spark, cfg)
    land_snapshot(_venues(spark, *"cd"), cfg.bronze_root, None, B)

    def killed(*a, **k):
        raise Crash

    with monkeypatch.context() as m:
        m.setattr(versions, "delete_path", lambda *a: None)  # a killed driver cleans nothing up
        if step in (0, 1):
            make = ("table_writer", "csv_writer")[step]
            m.setattr(files, make, lambda *a, **k: killed)
        elif step == 2:
            m.setattr(versions, "_locked", killed)
        elif step == 3:
            create = versions.create_new
            m.setattr(versions, "create_new", lambda s, p, *a: create(s, p, *a) if "lock-" in p else killed())
        elif step == 4:
            m.setattr(flows, "write_watermark", killed)
        else:
            m.setattr(versions, "vacuum", killed)
        with pytest.raises(Crash):
            bronze_to_silver(spark, cfg)
    new = (["c", "d"], ["c", "d"], {B})
    assert _state(spark, cfg) == (new if step >= 4 else before)
    if step == 3:  # the lock of the killed job is left
        with pytest.raises(RuntimeError, match="being replaced"):
            bronze_to_silver(spark, cfg)
        monkeypatch.setattr(versions, "LOCK_AGE_S", -1)
    out = bronze_to_silver(spark, cfg)
    assert out["status"] == ("nothing_new" if step >= 4 else "written") and _state(spark, cfg) == new
    assert read_watermark(spark, cfg.watermark_path) == B  # also where its row was missing
    # orphans of the killed run go by age, those of readers stay
    monkeypatch.setattr(versions, "ORPHAN_AGE_S", 0)
    vacuum(spark, cfg.silver_path, 0), vacuum(spark, cfg.csv_path, 0)
    for path in (cfg.silver_path, cfg.csv_path):
        named = {n.split("-")[1] for n in os.listdir(f"{cfg.silver_path}/_pointer") if n[:12].isdigit()}
        assert set(os.listdir(f"{path}/_versions")) <= named and 1 <= len(named) <= 3


def test_a_watermark_moved_back_runs_again(spark, tmpdir_path):
    cfg = _cfg(tmpdir_path)
    land_snapshot(_venues(spark, "a"), cfg.bronze_root, None, A)
    assert bronze_to_silver(spark, cfg)["status"] == "written"
    assert bronze_to_silver(spark, cfg)["status"] == "nothing_new"
    reset_watermark(spark, cfg.watermark_path, EPOCH_STAMP)
    assert published_watermark(spark, cfg.watermark_path, cfg.silver_path) == EPOCH_STAMP
    assert bronze_to_silver(spark, cfg)["status"] == "written"


def test_gold_is_one_set_too(spark, tmpdir_path, monkeypatch):
    cfg = _cfg(tmpdir_path)
    gold = GoldConfig(silver_path=cfg.silver_path, gold_path=f"{tmpdir_path}/gold", watermark_path=f"{tmpdir_path}/gold_wm", keys=["nation"],
                      count_col="venue_key", count_alias="n", csv_path=f"{tmpdir_path}/gold_csv", skip_if_current=True)
    for stamp, keys in ((A, "ab"), (B, "abc")):
        land_snapshot(_venues(spark, *keys), cfg.bronze_root, None, stamp)
        bronze_to_silver(spark, cfg)
        with monkeypatch.context() as m:
            m.setattr(flows, "write_watermark", lambda *a: None)  # killed before its row
            assert silver_to_gold(spark, gold)["status"] == "written"
        assert silver_to_gold(spark, gold)["status"] == "current"
        csv = spark.read.option("header", True).csv(current_path(spark, gold.csv_path)).first()
        assert read_table(spark, gold.gold_path).first()["n"] == len(keys) == int(csv["n"])
        assert current_commit(spark, gold.csv_path).stamp == stamp == read_watermark(spark, gold.watermark_path)


def test_members_of_a_set_are_not_replaced_alone(spark, tmpdir_path):
    table, mirror = f"{tmpdir_path}/t", f"{tmpdir_path}/m"
    overwrite_table(spark.range(1), table)
    export_csv(spark.range(2), mirror)
    publish(spark.range(5), table, csv_path=mirror, stamp=A)  # both were single before
    assert read_table(spark, table).count() == 5 == spark.read.option("header", True).csv(current_path(spark, mirror)).count()
    with pytest.raises(ValueError, match="together"):
        overwrite_table(spark.range(3), table)
    with pytest.raises(ValueError, match="committed with"):
        export_csv(spark.range(3), mirror)
    with pytest.raises(ValueError, match="committed with"):
        publish(spark.range(5), f"{tmpdir_path}/u", csv_path=mirror)
    # the mirror's commit is the table's
    assert current_commit(spark, table) == current_commit(spark, mirror)


def test_of_two_replacements_at_once_one_raises(spark, tmpdir_path):
    path = f"{tmpdir_path}/t"
    overwrite_table(spark.range(1), path)

    def slow(folder):
        overwrite_table(spark.range(7), path)  # the other one, meanwhile
        spark.range(3).write.parquet(folder)

    with pytest.raises(RuntimeError, match="replaced"):
        replace_dataset(spark, path, slow)
    assert read_table(spark, path).count() == 7
    assert len(os.listdir(f"{path}/_versions")) == 2 and not [n for n in os.listdir(f"{path}/_pointer") if n.startswith("lock")]


def test_orphans_go_and_versions_of_readers_stay(spark, tmpdir_path):
    path = f"{tmpdir_path}/a table"
    for n in (1, 2):
        overwrite_table(spark.range(n), path)
    reading = read_table(spark, path)  # its files stay for one more replacement
    with pytest.raises(Exception, match="boom"):
        overwrite_table(spark.range(5).select(F.raise_error(F.lit("boom")).cast("int").alias("x")), path)
    assert len(os.listdir(f"{path}/_versions")) == 2  # the failed write removed its folder
    os.makedirs(f"{path}/_versions/killed/_temporary")  # a job that was killed, or one that still writes
    overwrite_table(spark.range(3), path)
    assert "killed" in os.listdir(f"{path}/_versions") and reading.count() == 2
    assert vacuum(spark, path) == [] and vacuum(spark, path, 0) == ["killed"]
    assert reading.count() == 2 and read_table(spark, path).count() == 3


def test_a_set_needs_all_its_writes(spark, tmpdir_path):
    def fail(folder, done):
        assert os.path.isdir(done[f"{tmpdir_path}/t"])
        raise OSError("disk")

    with pytest.raises(OSError):
        replace_set(spark, {f"{tmpdir_path}/t": lambda f, d: spark.range(2).write.parquet(f), f"{tmpdir_path}/m": fail})
    assert current_commit(spark, f"{tmpdir_path}/t") is None and os.listdir(f"{tmpdir_path}/t/_versions") == []


@pytest.mark.parametrize("name", ["plain", "w m", "50%", "a%20b", "ü+x"])
def test_watermark_compaction_under_odd_paths(spark, tmpdir_path, name):
    path = os.path.join(tmpdir_path, name, "wm")
    for i in range(5):
        write_watermark(spark, path, f"2024030{i + 1}_000000_000000")
    for _ in range(2):
        compact_watermark(spark, path, max_files=1)
        assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) == 1
    assert read_watermark(spark, path) == "20240305_000000_000000"


def _commit_many(spark, root, days, per_file):
    """Landings as their commit rows alone, ``per_file`` to a file."""
    rows = spark.range(days * 4).select(F.format_string("%s_%06d_000000", F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), F.floor(
        F.col("id") / 4).cast("int")), "yyyyMMdd"), F.col("id") % 4).alias("stamp")).select(
        "stamp", F.concat(F.lit("f/"), "stamp").alias("folder"), F.lit(1).cast("long").alias("rows"))
    rows.repartitionByRange(max(1, days * 4 // per_file), "stamp").write.mode("append").parquet(commits_path(root))
    return rows.agg(F.max("stamp")).first()[0]


def test_ten_thousand_landings_are_read_in_bounds(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "bronze dir")
    last = _commit_many(spark, root, 2500, 100)
    assert not compact_commits(spark, root, max_files=10)  # a stream may not have seen them
    assert compact_commits(spark, root, max_files=10, keep_s=0)
    assert not [f for f in os.listdir(commits_path(root)) if f.endswith(".parquet")]
    assert newest_commit(spark, root).stamp == last
    land_json(_records(spark), root, "20300101_000000_000000")
    assert newest_commit(spark, root).stamp == "20300101_000000_000000"
    # the history is known by month: a stamp is looked up in one folder of 83
    old = "20210101_000002_000000"
    assert committed_among(spark, root, [old, "20210101_000009_000000"]) == [old]
    with pytest.raises(ValueError, match="committed already"):
        land_json(_records(spark), root, old)
    kept = spark.read.schema(COMMIT_SCHEMA + ", month string").parquet(f"{current_path(spark, kept_path(root))}/rows")
    one = kept.where("month = '202101'")
    one._jdf.queryExecution().toRdd().count()
    scan = one._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().apply("numFiles").value() == 1 and kept.count() == 10_000
    # a second compaction keeps all rows
    append_commits(spark.createDataFrame([("20290101_000000_000000", "x", 1)], COMMIT_SCHEMA), root)
    assert compact_commits(spark, root, max_files=0, keep_s=0)
    assert newest_commit(spark, root).stamp == "20300101_000000_000000" and committed_among(spark, root, [old, "20290101_000000_000000"])[0] == old


def test_a_stream_publishes_once_over_a_compaction(spark, tmpdir_path):
    from tierkit.streaming.incremental import stream_bronze_to_silver

    cfg, checkpoint = _cfg(tmpdir_path), f"{tmpdir_path}/checkpoint"
    seen = []
    for stamp, keys in ((A, "ab"), (B, "cd"), ("20240307_000000_000000", "e")):
        land_snapshot(_venues(spark, *keys), cfg.bronze_root, None, stamp)
        stream_bronze_to_silver(spark, cfg, checkpoint)
        seen.append(current_commit(spark, cfg.silver_path))
        compact_commits(spark, cfg.bronze_root, max_files=0, keep_s=0)
        stream_bronze_to_silver(spark, cfg, checkpoint)  # moved rows are no new landings
        assert current_commit(spark, cfg.silver_path) == seen[-1] and seen[-1].stamp == stamp
    assert [c.number for c in seen] == [1, 2, 3] and _state(spark, cfg)[0] == ["e"]


def test_listing_helpers(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "x y", "f")
    assert control.create_new(spark, path, "text") and not control.create_new(spark, path)
    assert control.file_text(spark, path) == "text" and control.file_text(spark, path + "2") is None
    shutil.copy(path, path + "3")
    with pytest.raises(RuntimeError):
        control.rename_path(spark, path, path + "3")
    assert control.fresh_name(["A", "_b"], "a") == "_a" and control.fresh_name(["a"], "b") == "b"
