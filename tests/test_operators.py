"""S1/S1a, J2, A3, W1 options, K2/K3, S4 and plan shape checks."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tierkit.operators.aggregate import group_count
from tierkit.operators.dedup import first_per_key
from tierkit.operators.enrich import broadcast_row_bytes, enrich_left, session_broadcast_limit, \
    size_in_bytes
from tierkit.operators.snapshot import latest_snapshot, max_stamp, newer_than
from tierkit.sinks.files import export_csv, land_json, overwrite_table
from tierkit.sinks.layout import cluster_layout, file_ranges, overlapping_files
from tierkit.sources.pages import BadPageError, NoRecordsError, paged_records
from tierkit.sources.reference import read_reference_csv
from tierkit.sources.snapshots import read_snapshots
from tierkit.sources.tables import read_table

REC = "id bigint, v string"


def _page(rows):
    return json.dumps([{"id": i, "v": f"r{i}"} for i in rows])


def test_pages_stop_at_first_empty(spark):
    pages = spark.createDataFrame(
        [(1, _page([1, 2])), (2, _page([3])), (3, "[]"), (4, _page([9]))], "page int, body string")
    got = sorted(r.id for r in paged_records(pages, REC).collect())
    assert got == [1, 2, 3]


def test_pages_without_empty_page_keep_all(spark):
    pages = spark.createDataFrame([(1, _page([1])), (2, _page([2]))], "page int, body string")
    assert paged_records(pages, REC).count() == 2


@pytest.mark.parametrize("bad", [None, '[{"id": 3, "v": "x"', '{"id": 3}', "", "null"])
def test_bad_page_before_the_end_raises(spark, bad):
    rows = [(1, _page([1, 2])), (2, bad), (3, _page([4])), (4, "[]")]
    with pytest.raises(BadPageError):
        paged_records(spark.createDataFrame(rows, "page int, body string"), REC)
    # after the first empty page nothing is looked at
    late = [(1, _page([1])), (2, "[]"), (3, bad)]
    assert paged_records(spark.createDataFrame(late, "page int, body string"), REC).count() == 1


@pytest.mark.parametrize("pages", [[], [(1, "[]"), (2, "[{\"id\": 1, \"v\": \"a\"}]")]])
def test_pages_nothing_raises(spark, pages):
    df = spark.createDataFrame(pages, "page int, body string")
    with pytest.raises(NoRecordsError):
        paged_records(df, REC, check_nonempty=True)


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle", "auto"])
def test_enrich_left(spark, strategy):
    facts = spark.createDataFrame(
        [(1, "austria", "09020"), (2, "austria", "11111"), (3, "austria", None),
         (4, "germany", "09020"), (5, None, "09020")],
        "fid int, country string, postal_code string")
    ref = spark.createDataFrame(
        [("austria", "09020", "AT", "Kärnten"), ("austria", "09020", "AT", "Kärnten"),
         ("germany", "09020", "DE", "Bayern"), ("austria", "02320", "AT", "Niederösterreich")],
        "country string, postal_code string, country_iso2_code string, "
        "administrative_area_name string")
    out = enrich_left(facts, ref, ["country", "postal_code"],
                      ["country_iso2_code", "administrative_area_name"], strategy=strategy)
    got = {r.fid: (r.country_iso2_code, r.administrative_area_name) for r in out.collect()}
    assert out.count() == 5
    assert got == {1: ("AT", "Kärnten"), 2: (None, None), 3: (None, None),
                   4: ("DE", "Bayern"), 5: (None, None)}


def test_enrich_auto_falls_back_to_shuffle(spark):
    facts = spark.createDataFrame([(1, "a"), (2, None)], "fid int, k string")
    ref = spark.createDataFrame([("a", "x"), ("b", "y")], "k string, attr string")
    out = enrich_left(facts, ref, ["k"], ["attr"], max_broadcast_rows=1)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Union" not in plan and "BroadcastHashJoin" not in plan
    with pytest.raises(ValueError, match="too large"):
        enrich_left(facts, ref, ["k"], ["attr"], strategy="broadcast", max_broadcast_rows=1)
    assert sorted((r.fid, r.attr) for r in out.collect()) == [(1, "x"), (2, None)]


def test_enrich_auto_checks_bytes(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "b")], "fid int, k string")
    ref = spark.createDataFrame([("a", "x" * 100), ("b", "y")], "k string, attr string")
    # 2 rows: 8 (null bits) + 2 * 8 (fields) = 24 each, plus 8 ("a") + 104 and 8 + 8
    rows = ref.select(broadcast_row_bytes(ref).alias("b")).collect()
    assert sorted(r.b for r in rows) == [24 + 8 + 8, 24 + 8 + 104]
    small = enrich_left(facts, ref, ["k"], ["attr"], max_broadcast_bytes=200)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    big = enrich_left(facts, ref, ["k"], ["attr"], max_broadcast_bytes=100)
    plan = big._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan
    assert sorted((r.fid, len(r.attr)) for r in big.collect()) == [(1, 100), (2, 1)]
    assert session_broadcast_limit(spark) == 10 * 1024 * 1024  # Spark's default
    assert [size_in_bytes(t) for t in ("10485760b", "20MB", "1g", "-1", "512")] == \
        [10485760, 20 << 20, 1 << 30, -1, 512]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        off = enrich_left(facts, ref, ["k"], ["attr"])
        assert "BroadcastHashJoin" not in off._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_group_count_nulls(spark):
    df = spark.createDataFrame([("x", None, 1), ("x", None, None), ("x", "a", None)],
                               "nation string, kind string, id int")
    got = {(r.nation, r.kind): r.n for r in group_count(df, ["nation", "kind"], "id", "n").collect()}
    assert got == {("x", None): 1, ("x", "a"): 0}


def test_first_per_key_nulls_and_options(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (" a", 3), (None, 4), (None, 5)],
                               "k string, v int")
    one = first_per_key(df, ["k"], [F.col("v").desc()], [F.col("v")])
    assert sorted(map(repr, one.collect())) == sorted(map(repr, [
        df.where("v = 2").first(), df.where("v = 3").first(), df.where("v = 5").first()]))
    keep = first_per_key(df, ["k"], [F.col("v").desc()], [F.col("v")], keep_null_keys=True)
    assert sorted(r.v for r in keep.collect()) == [2, 3, 4, 5]
    norm = first_per_key(df, ["k"], [F.col("v").desc()], [F.col("v")],
                         normalize_key=lambda c: F.trim(c))
    assert sorted(r.v for r in norm.collect()) == [3, 5]
    with pytest.raises(ValueError):
        first_per_key(df, ["k"], [F.col("v")], [])


def test_first_per_key_plan_has_partial_limit(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    out = first_per_key(df, ["k"], [F.col("id").desc()], [F.col("id")])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_latest_snapshot_and_max(spark):
    df = spark.createDataFrame([("s1", 1), ("s2", 2), ("s2", 3), ("", 4)], "stamp string, v int")
    assert sorted(r.v for r in latest_snapshot(df, "stamp").collect()) == [2, 3]
    assert latest_snapshot(df, "stamp", since="s2").count() == 0
    assert max_stamp(df, "stamp", since="s2").first().max_stamp is None
    assert newer_than(df, "stamp", None).count() == 3  # '' never newer than epoch
    plan = latest_snapshot(df, "stamp")._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" in plan


def test_csv_roundtrip_lossy(spark, tmpdir_path):
    df = spark.createDataFrame([(1, "a", "at"), (None, "", "at"), (3, None, "unknown")],
                               "n int, s string, country string")
    p = os.path.join(tmpdir_path, "csv")
    export_csv(df, p, ["country"])
    back = read_reference_csv(spark, p, schema=df.schema)
    assert back.columns[-1] == "country"
    got = sorted((r.n or 0, r.s, r.country) for r in back.collect())
    assert got == [(0, None, "at"), (1, "a", "at"), (3, None, "unknown")]


def test_reference_csv_keeps_leading_zeros(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "ref.csv")
    with open(p, "w", encoding="utf-8") as f:
        f.write("country,postal_code\naustria,09020\n")
    row = read_reference_csv(spark, p, ["country", "postal_code"]).first()
    assert row.postal_code == "09020"


def test_overwrite_is_static(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "t")
    overwrite_table(spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string"), p, ["p"])
    overwrite_table(spark.createDataFrame([(3, "a")], "v int, p string"), p, ["p"])
    assert [(r.v, r.p) for r in read_table(spark, p).collect()] == [(3, "a")]


def test_land_json_layout_and_scan(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "bronze")
    df = spark.createDataFrame([("x", "é", None)], "id string, name string, city string")
    stamp = land_json(df, root, stamp="20250711_080910_000111")
    assert stamp == "20250711_080910_000111"
    d = os.path.join(root, "year=2025", "month=07", "day=11", f"snapshot={stamp}")
    files = [f for f in os.listdir(d) if f.endswith(".json")]
    text = open(os.path.join(d, files[0]), encoding="utf-8").read()
    assert '"name":"é"' in text and '"city":null' in text
    back = read_snapshots(spark, root, "id string, name string, city string")
    r = back.first()
    assert (r.id, r.name, r.city, r.snapshot_stamp, r.month) == ("x", "é", None, stamp, "07")
    pruned = back.where(F.col("snapshot_stamp") > stamp)
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [CASE" in plan  # the stamp filter prunes directories
    assert pruned.count() == 0


def test_cluster_layout_files_do_not_overlap(spark, tmpdir_path):
    p, q = os.path.join(tmpdir_path, "c"), os.path.join(tmpdir_path, "plain")
    df = spark.range(2000).select((F.col("id") % 4).cast("string").alias("a"),
                                  (F.col("id") % 7).alias("b"), "id")
    cluster_layout(df, p, ["a", "b"], num_files=4)
    back = read_table(spark, p)
    assert back.count() == 2000 and file_ranges(back, ["a", "b"]).count() == 4
    assert tuple(overlapping_files(back, ["a", "b"]).first()) == (2000, 0)
    overwrite_table(df.repartition(4), q)  # not clustered: every file spans all keys
    assert overlapping_files(read_table(spark, q), ["a", "b"]).first()["overlapping_files"] == 3


def test_ranges_grow_with_rows(spark, tmpdir_path, monkeypatch):
    """A task sorts a range: the query's eight files are the fewest, not all there may be."""
    from tierkit import workloads
    from tierkit.sinks import layout

    rows = spark.range(3000).select(
        (F.col("id") % 3).cast("string").alias("l_returnflag"), F.when(F.col("id") % 5 > 0, "O").alias("l_linestatus"),
        F.col("id").alias("l_orderkey"), (F.col("id") % 200).alias("l_partkey"))
    rows.write.parquet(f"{tmpdir_path}/lineitem.parquet")
    assert workloads.q_cluster_file_ranges(spark, tmpdir_path).first() == (3000, 0)
    monkeypatch.setattr(layout, "RANGE_ROWS", 100)
    assert workloads.q_cluster_file_ranges(spark, tmpdir_path).first() == (3000, 0)
    for min_files in (1, 8):
        back = workloads._clustered_lineitem(spark, tmpdir_path, min_files=min_files)
        ranges = file_ranges(back, workloads.CLUSTER_KEYS).collect()
        assert len(ranges) > 20 and max(r.rows for r in ranges) < 300
        assert sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))


def test_file_ranges_sort_no_rows(spark, tmpdir_path):
    df = spark.createDataFrame([(None, 1, 1), ("a", None, 2), ("a", 2, 3), ("b", 1, 4)], "file string, key int, v int")
    overwrite_table(df.coalesce(1), tmpdir_path + "/t")
    ranges = file_ranges(read_table(spark, tmpdir_path + "/t"), ["file", "key"])
    assert [tuple(r)[1:] for r in ranges.collect()] == [(4, (None, 1), ("b", 1))]
    plan = ranges._jdf.queryExecution().sparkPlan().toString()
    scan = plan.index("FileScan")
    lowest = max((i, op) for op in ("HashAggregate", "SortAggregate") for i in [plan.rfind(op, 0, scan)])[1]
    assert lowest == "HashAggregate"  # rows of the scan; a sort sees one row per file and tuple


def test_literal_rows_and_pandas(spark):
    from tierkit.sources.tables import literal_rows

    df = literal_rows(spark, [(7, "north", 1.5), (9, "south", 2.5)], ["key", "side", "weight"])
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["bigint", "string", "double"]
    assert df.toPandas()["weight"].tolist() == [1.5, 2.5]


def test_audit_columns_fixed_and_aware(spark):
    from datetime import datetime, timezone

    from tierkit.operators.aggregate import audit_columns

    df = spark.range(2)
    a = audit_columns(df, datetime(2025, 1, 1)).select("created_at", "updated_at").distinct()
    assert a.count() == 1
    r = audit_columns(df, datetime(2025, 1, 1, tzinfo=timezone.utc)).first()
    assert r.created_at == r.updated_at


def test_table_bytes_from_listing(spark):
    import os

    from tierkit.sources.tables import table_bytes

    path = "/root/testdata/sf0.001/lineitem.parquet"
    assert table_bytes(spark, path) == os.path.getsize(path)


@pytest.mark.parametrize("numbers", [[1, 3], [2, 3], [1, 2, 2, 3], [1, None, 2]])
def test_pages_with_gaps_raise(spark, numbers):
    for end in ([], [(4, "[]")]):
        rows = [(n, _page([1])) for n in numbers] + end
        with pytest.raises(BadPageError):
            paged_records(spark.createDataFrame(rows, "page int, body string"), REC)
    # pages behind the end don't count, and a source may number from 0
    late = [(0, _page([5])), (1, "[]"), (3, _page([6])), (3, _page([6]))]
    assert paged_records(spark.createDataFrame(late, "page int, body string"), REC, first_page=0).count() == 1


def test_no_records_is_an_error_by_default(spark):
    with pytest.raises(NoRecordsError):
        paged_records(spark.createDataFrame([(1, "[]")], "page int, body string"), REC)
    assert paged_records(spark.createDataFrame([(1, "[]")], "page int, body string"), REC, check_nonempty=False).count() == 0


HELPERS = ["__salt", "__spread", "__k0", "__rn", "__a", "__r", "__latest", "__Salt2"]


@pytest.mark.parametrize("name", HELPERS)
def test_columns_named_like_a_helper(spark, tmpdir_path, name):
    from tierkit.operators.dedup import first_per_key
    from tierkit.operators.snapshot import latest_snapshot

    df = spark.createDataFrame([("x", 1, "a"), ("x", 2, "b"), (None, 3, "c")], f"k string, `{name}` int, s string")
    ref = spark.createDataFrame([("x", "attr"), ("y", "other")], f"k string, `{'__a' if name != '__a' else 'v'}` string")
    attr = ref.columns[1]
    for strategy in ("broadcast", "shuffle"):
        out = enrich_left(df, ref, ["k"], [attr], strategy=strategy)
        assert out.columns == ["k", name, "s", attr]
        assert sorted((r[1], r[3]) for r in out.collect()) == [(1, "attr"), (2, "attr"), (3, None)]
    assert sorted(first_per_key(df, ["k"], [F.col(name)], [F.col("s")]).collect(), key=str) == sorted(
        df.where(F.col(name) != 2).collect(), key=str)
    assert latest_snapshot(df, "s", "a").collect() == [(None, 3, "c")]
    path = os.path.join(tmpdir_path, "t")
    cluster_layout(df, path, [name], num_files=2)
    assert sorted(map(str, read_table(spark, path).collect())) == sorted(map(str, df.collect()))


def test_a_filter_skips_files_of_the_clustered_table(spark, tmpdir_path):
    from tierkit.sinks.layout import rows_scanned

    df = spark.range(8000).select((F.col("id") * 7919 % 8000).alias("k"), F.col("id").cast("string").alias("v"))
    decoded = {}
    for name in ("dealt", "clustered"):
        path = os.path.join(tmpdir_path, name)
        if name == "dealt":
            overwrite_table(df.repartition(8), path)
        else:
            cluster_layout(df, path, ["k"], num_files=8)
        found, decoded[name] = rows_scanned(read_table(spark, path).where("k between 100 and 199"))
        assert found == 100
    assert decoded["dealt"] == 8000 and decoded["clustered"] <= 2000
