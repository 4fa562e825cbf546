"""Registered workloads: every operator run over the driver's test tables.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame.  Sink
workloads write to a fresh folder under the shared scratch root and return
what they read back.  ``tierkit.oracles`` holds the matching DuckDB SQL.

Input shapes: the reference lands a directory of venues as daily JSON
snapshots.  ``venue_records`` derives such records from the test tables -
one record per event, described by the customer (and its nation) behind it -
with a snapshot stamp per event day, so the newest-snapshot, dedup and
aggregation semantics are exercised on data that grows with the scale factor.
"""

from __future__ import annotations

import re
import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tierkit.functions import stamps as S
from tierkit.functions import text as T
from tierkit.control import hadoop_path, rows_of
from tierkit.functions.jsonx import JSON_KEEP_NULLS, from_json_record, to_json_line
from tierkit.operators.aggregate import audit_columns, group_count, row_count
from tierkit.operators.dedup import first_per_key
from tierkit.operators.enrich import enrich_left
from tierkit.operators.guards import filter_eq, is_empty, preview
from tierkit.operators.project import apply_rules
from tierkit.operators.snapshot import latest_snapshot, max_stamp, newer_than
from tierkit.plans.flows import Enrichment, GoldConfig, SilverConfig, bronze_to_silver as run_silver, \
    land_snapshot, run_all, silver_to_gold as run_gold
from tierkit.plans.statements import gold_statement, silver_statement
from tierkit.plans.watermark import effective_watermark, read_watermark, write_watermark
from tierkit.session import job_session, scratch_path
from tierkit.sinks.commits import COMMIT_SCHEMA, commits_path
from tierkit.sinks.files import export_csv, land_json, overwrite_table
from tierkit.sinks.layout import cluster_layout, overlapping_files, rows_scanned
from tierkit.sources.pages import paged_records
from tierkit.sources.reference import read_reference_csv
from tierkit.sources.snapshots import newest_snapshot, read_snapshots
from tierkit.sources.tables import read_table, table_bytes

# Fixed parameters of the workloads (shared with the oracle SQL).
AS_OF = datetime(2025, 1, 1, 0, 0, 0)
MID_WATERMARK = "20240115_000000_000000"
PAGE_SIZE = 200

RECORD_FIELDS = ["venue_key", "line", "label", "kind", "channel", "floor", "spare", "nation", "area",
                 "province", "area_code", "amount", "opposite", "payload"]
RECORD_SCHEMA = StructType([StructField(f, StringType(), True) for f in RECORD_FIELDS])

# The silver projection as data.
SILVER_RULES = {
    "venue_key": "id",
    "nation": "slug",
    "area": "text_or_unknown",
    "province": "text_or_unknown",
    "amount": "double",
    "opposite": "double",
    **{f: "text" for f in ("line", "label", "kind", "channel", "floor", "spare", "area_code", "payload")},
}
STAMP_COL = "snapshot_stamp"
GOLD_KEYS = ["nation", "kind"]
GOLD_COUNT = "n_venues"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def day_stamp(ts) -> F.Column:
    """Snapshot stamp of an event's day: ``yyyyMMdd_000000_000000``."""
    t = F.col(ts) if isinstance(ts, str) else ts
    return F.concat(F.date_format(t, "yyyyMMdd"), F.lit("_000000_000000"))


def venue_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw venue records (all text, like an API) with a ``stamp`` per event day."""
    ev = table(spark, sf_dir, "events")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey",
                                                    "c_mktsegment")
    nat = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    cn = cust.join(nat, cust.c_nationkey == nat.n_nationkey, "left")
    j = ev.join(cn, ev.user_id == cn.c_custkey, "left")
    et = F.col("event_type")
    return j.select(
        F.col("user_id").cast("string").alias("venue_key"),
        F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("line"),
        F.col("c_name").alias("label"),
        F.col("c_mktsegment").alias("kind"),
        et.alias("channel"),
        F.when(et == "view", F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit(" Floor "), et, F.lit(" "))).alias("floor"),
        F.lit(None).cast("string").alias("spare"),
        F.col("n_name").alias("nation"),
        F.when(et == "error", F.lit("  ")).otherwise(F.col("n_name")).alias("area"),
        F.when(et == "purchase", F.lit(None).cast("string"))
         .otherwise(F.upper(F.col("n_name"))).alias("province"),
        F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("area_code"),
        F.col("value").cast("string").alias("amount"),
        F.when(et == "click", F.lit("n/a"))
         .otherwise((-F.col("value")).cast("string")).alias("opposite"),
        F.col("props").alias("payload"),
        day_stamp("ts").alias("stamp"),
    )


def events_stamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("stamp", day_stamp("ts"))


def _land_venues(spark: SparkSession, sf_dir: str) -> str:
    root = scratch_path(spark, "bronze")
    land_json(venue_records(spark, sf_dir), root, stamp_col="stamp")
    return root


def _silver_cfg(spark: SparkSession, bronze_root: str, **more) -> SilverConfig:
    return SilverConfig(
        bronze_root=bronze_root,
        silver_path=scratch_path(spark, "silver"),
        watermark_path=scratch_path(spark, "silver-wm"),
        record_schema=RECORD_SCHEMA,
        rules=SILVER_RULES,
        key="venue_key",
        tie_break=[F.col("line").desc()],
        partition_by=["nation"],
        csv_path=scratch_path(spark, "silver-csv"),
        stamp_col=STAMP_COL,
        **more,
    )


def _gold_cfg(spark: SparkSession, silver_path: str) -> GoldConfig:
    return GoldConfig(
        silver_path=silver_path,
        gold_path=scratch_path(spark, "gold"),
        watermark_path=scratch_path(spark, "gold-wm"),
        keys=GOLD_KEYS,
        count_col="venue_key",
        count_alias=GOLD_COUNT,
        csv_path=scratch_path(spark, "gold-csv"),
        stamp_col=STAMP_COL,
        text_partitions=("nation",),
    )


def _silver_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    recs = venue_records(spark, sf_dir).withColumnRenamed("stamp", STAMP_COL)
    spec = dict(SILVER_RULES)
    spec[STAMP_COL] = "keep"
    return apply_rules(recs, spec)


def _nation_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = table(spark, sf_dir, "customer")
    nat = table(spark, sf_dir, "nation")
    return cust.join(nat, cust.c_nationkey == nat.n_nationkey, "left")


# --- sources ------------------------------------------------------------------

def q_scan_json_snapshots(spark, sf_dir):
    root = _land_venues(spark, sf_dir)
    scan = read_snapshots(spark, root, RECORD_SCHEMA, stamp_col=STAMP_COL)
    return scan.select(*[c for c in RECORD_FIELDS if c not in ("amount", "opposite")],
                       T.try_double("amount").alias("amount"),
                       T.try_double("opposite").alias("opposite"), STAMP_COL)


def q_land_json_partitioned(spark, sf_dir):
    root = _land_venues(spark, sf_dir)
    scan = read_snapshots(spark, root, RECORD_SCHEMA, stamp_col=STAMP_COL)
    return scan.select("line", "year", "month", "day", "snapshot")


def q_scan_csv_reference(spark, sf_dir):
    path = scratch_path(spark, "ref-csv")
    cust = table(spark, sf_dir, "customer")
    export_csv(cust.select(
        F.col("c_custkey").cast("string").alias("customer_key"),
        F.col("c_name").alias("customer_name"),
        F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("postal_code"),
        F.col("c_mktsegment").alias("segment")), path)
    return read_reference_csv(spark, path, ["customer_key", "customer_name", "postal_code",
                                            "segment"])


def _pages(spark, sf_dir) -> DataFrame:
    """Customer rows served in pages of ``PAGE_SIZE``; after the last real page
    the source returns one empty page and then stale copies of every page."""
    cust = table(spark, sf_dir, "customer")
    rec = F.struct("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    # one group per key range of PAGE_SIZE: at most PAGE_SIZE records each, as
    # c_custkey is the table's key - one bounded API response per group
    pages = (cust.groupBy((F.floor(F.col("c_custkey") / PAGE_SIZE) + 1).alias("page"))
             .agg(F.to_json(F.collect_list(rec)).alias("body")))
    last = pages.agg(F.max("page").alias("m")).first()["m"] or 0
    empty = spark.createDataFrame([(last + 1, "[]")], "page bigint, body string")
    stale = pages.select((F.col("page") + last + 1).alias("page"), "body")
    return pages.unionByName(empty).unionByName(stale)


def q_paged_records(spark, sf_dir):
    return paged_records(_pages(spark, sf_dir),
                         "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                         "c_mktsegment string")


def q_watermark_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "wm")
    absent = effective_watermark(spark, path)
    ev = events_stamped(spark, sf_dir)
    mid = max_stamp(ev, "stamp", since=None).first()["max_stamp"]
    older = ev.agg(F.min("stamp").alias("m")).first()["m"]
    write_watermark(spark, path, mid)
    write_watermark(spark, path, older)  # an older commit never moves it back
    return spark.createDataFrame([(absent, read_watermark(spark, path))],
                                 "absent_default string, watermark string")


# --- projections / filters / aggregates ----------------------------------------

def _viewed(spark, df: DataFrame, statement, args: dict) -> DataFrame:
    """``statement(view)`` over ``df`` as a view of its own name, which goes again once it is resolved."""
    view = f"rows_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(view)
    try:
        return df.sparkSession.sql(statement(view), args=args)
    finally:
        df.sparkSession.catalog.dropTempView(view)


def q_gold_sql_view(spark, sf_dir):
    return _viewed(spark, _silver_all(spark, sf_dir),
                   lambda v: gold_statement(v, GOLD_KEYS, "venue_key", GOLD_COUNT),
                   {"as_of": AS_OF.strftime("%Y-%m-%d %H:%M:%S")})


def q_silver_sql(spark, sf_dir):
    """The silver step as SQL text with a bound stamp, over all landed snapshots."""
    scan = read_snapshots(spark, _land_venues(spark, sf_dir), RECORD_SCHEMA, stamp_col=STAMP_COL)
    return _viewed(spark, scan, lambda v: silver_statement(v, SILVER_RULES, "venue_key", STAMP_COL, "line DESC"),
                   {"stamp": MID_WATERMARK})


def _land_events(spark, sf_dir) -> DataFrame:
    """Events as landed snapshots: a stamp filter on the scan is a partition filter."""
    root = scratch_path(spark, "events")
    land_json(events_stamped(spark, sf_dir).select("event_id", "user_id", "stamp"), root, stamp_col="stamp")
    return read_snapshots(spark, root, "event_id bigint, user_id bigint", stamp_col="stamp").select(
        "event_id", "user_id", "stamp")


def q_watermark_filter(spark, sf_dir):
    return newer_than(_land_events(spark, sf_dir), "stamp", MID_WATERMARK)


def q_max_stamp_since(spark, sf_dir):
    return max_stamp(_land_events(spark, sf_dir), "stamp", since=MID_WATERMARK)


def q_max_stamp_all(spark, sf_dir):
    return max_stamp(events_stamped(spark, sf_dir), "stamp")


def q_latest_snapshot(spark, sf_dir):
    return latest_snapshot(_land_events(spark, sf_dir), "stamp")


def q_first_per_key(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return first_per_key(ev, ["user_id"], order=[F.col("ts").desc()],
                         tie_break=[F.col("event_id").desc()]).select(
        "user_id", "event_id", "ts", "event_type", "value")


def q_norm_text(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    maybe_null = F.when(F.col("source") == "src0", F.lit(None)).otherwise(F.col("source"))
    return d.select("doc_id", T.norm_text("text").alias("text_norm"),
                    T.norm_text(F.concat(F.lit("  "), F.col("lang"), F.lit(" "))).alias("lang_norm"),
                    T.norm_text(maybe_null).alias("source_norm"))


def q_text_or_unknown(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    lang = (F.when(F.col("source") == "src1", F.lit("   "))
            .when(F.col("source") == "src2", F.lit(None)).otherwise(F.col("lang")))
    return d.select("doc_id", T.text_or_unknown(lang).alias("lang_or_unknown"),
                    T.text_or_unknown("text").alias("text_or_unknown"))


def q_slug(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", T.slug("text").alias("text_slug"),
                    T.slug("source").alias("source_slug"))


def q_fold_slug(spark, sf_dir):
    d = table(job_session(spark, None), sf_dir, "documents")
    return d.select("doc_id", T.fold_slug("text").alias("text_fold"))


def q_fold_slug_sql(spark, sf_dir):
    job = job_session(spark, None)
    T.register_fold_udf(job, "fold_slug")
    return _viewed(job, table(job, sf_dir, "documents"),
                   lambda v: f"SELECT doc_id, fold_slug(text) AS text_fold FROM {v}", {})


def q_try_double(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id").cast("string")
    et = F.col("event_type")
    raw = (F.when(et == "click", F.concat(eid, F.lit(".5")))
           .when(et == "view", F.concat(F.lit(" "), eid, F.lit(" ")))
           .when(et == "error", F.concat(F.lit("x"), eid))
           .when(et == "purchase", F.lit(""))
           .otherwise(F.concat(eid, F.lit("e-2"))))
    return ev.select("event_id", raw.alias("raw"), T.try_double(raw).alias("parsed"))


def q_regexp_extract_stamp(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    name = (F.when(F.col("event_type") == "error",
                   F.concat(F.lit("events_"), F.col("event_id").cast("string"), F.lit(".json")))
            .otherwise(F.concat(F.lit("events_"), S.stamp_format("ts"), F.lit(".json"))))
    return ev.select("event_id", name.alias("file_name"),
                     S.stamp_from_file_name(name).alias("stamp"))


def q_stamp_format(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", S.stamp_format("ts").alias("stamp"))


def q_date_parts(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    parts = S.date_parts("o_orderdate")
    return o.select("o_orderkey", *[c.alias(n) for n, c in parts.items()])


def q_json_roundtrip(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    line = to_json_line("event_id", "user_id", "event_type")
    back = from_json_record(line, "event_id bigint, user_id bigint, event_type string")
    k = from_json_record("props", "k bigint")
    return ev.select("event_id", line.alias("line"), back["user_id"].alias("user_id_back"),
                     back["event_type"].alias("event_type_back"), k["k"].alias("k"))


def q_silver_normalize(spark, sf_dir):
    return _silver_all(spark, sf_dir)


def q_filter_eq_select(spark, sf_dir):
    return filter_eq(table(spark, sf_dir, "customer"), "c_mktsegment", "AUTOMOBILE",
                     select=["c_custkey", "c_name", "c_mktsegment"])


def q_preview_head(spark, sf_dir):
    return preview(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal"),
                   5, order=[F.col("c_acctbal").desc(), F.col("c_custkey")])


def q_row_count(spark, sf_dir):
    return row_count(table(spark, sf_dir, "lineitem"))


def q_empty_guard(spark, sf_dir):
    ev = events_stamped(spark, sf_dir)
    newest = max_stamp(ev, "stamp").first()["max_stamp"]
    return spark.createDataFrame(
        [(is_empty(newer_than(ev, "stamp", newest)), is_empty(ev))],
        "nothing_newer boolean, events_empty boolean")


def q_group_count(spark, sf_dir):
    cn = _nation_country(spark, sf_dir)
    src = cn.select(T.slug("n_name").alias("nation"),
                    T.norm_text("c_mktsegment").alias("kind"),
                    F.col("c_custkey").alias("venue_key"))
    return group_count(src, GOLD_KEYS, "venue_key", GOLD_COUNT)


def q_audit_columns(spark, sf_dir):
    return audit_columns(q_group_count(spark, sf_dir), AS_OF)


def _reference_table(spark, sf_dir, code: str = "n_regionkey") -> DataFrame:
    """Reference derived from nation x region: (nation, area_code) -> region code and name; regions 0-3 only (region 4 stays unmatched) and
    every row twice (duplicates must not multiply facts)."""
    nat = table(spark, sf_dir, "nation")
    reg = table(spark, sf_dir, "region")
    ref = (nat.join(reg, nat.n_regionkey == reg.r_regionkey, "inner")
           .where(F.col("r_regionkey") < 4)
           .select(T.slug("n_name").alias("nation"),
                   F.lpad(F.col(code).cast("string"), 5, "0").alias("area_code"),
                   F.upper(F.substring(F.col("r_name"), 1, 2)).alias("region_code"),
                   F.col("r_name").alias("region_name")))
    return ref.unionByName(ref)


def q_enrich_left(spark, sf_dir):
    cn = _nation_country(spark, sf_dir)
    seg = F.col("c_mktsegment")
    code = (F.when(seg == "MACHINERY", F.lit(None).cast("string"))
            .when(seg == "BUILDING", F.lit("99999"))
            .otherwise(F.lpad(F.col("n_regionkey").cast("string"), 5, "0")))
    facts = cn.select("c_custkey", T.slug("n_name").alias("nation"), code.alias("area_code"))
    return enrich_left(facts, _reference_table(spark, sf_dir), ["nation", "area_code"], ["region_code", "region_name"])


# --- sinks ----------------------------------------------------------------------

def q_table_overwrite_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "table")
    silver = _silver_all(spark, sf_dir)
    # a first version under other partition values, then the real overwrite:
    # the static overwrite must drop every partition of the first version
    stale = silver.withColumn("nation", F.concat(F.lit("stale_"), F.col("nation")))
    overwrite_table(stale, path, ["nation"])
    overwrite_table(silver, path, ["nation"])
    return read_table(spark, path, text_partitions=("nation",))


def q_gold_table_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "gold-table")
    overwrite_table(q_audit_columns(spark, sf_dir), path)
    return read_table(spark, path)


def q_csv_export_partitioned(spark, sf_dir):
    path = scratch_path(spark, "csv-part")
    silver = _silver_all(spark, sf_dir)
    export_csv(silver, path, ["nation"])
    return read_reference_csv(spark, path, schema=silver.schema)


def q_csv_export_plain(spark, sf_dir):
    path = scratch_path(spark, "csv-plain")
    gold = q_audit_columns(spark, sf_dir)
    export_csv(gold, path)
    return read_reference_csv(spark, path, schema=gold.schema)


CLUSTER_KEYS = ["l_returnflag", "l_linestatus"]


def _clustered_lineitem(spark, sf_dir, keys=CLUSTER_KEYS, min_files: int = 1) -> DataFrame:
    """Line items written clustered and read back, in as many files as keep a task's sort small."""
    path, lineitem = scratch_path(spark, "clustered"), table(spark, sf_dir, "lineitem")
    cluster_layout(lineitem, path, keys, input_bytes=table_bytes(spark, f"{sf_dir}/lineitem.parquet"),
                   input_rows=lineitem.count(), min_files=min_files)
    return read_table(spark, path)


def q_cluster_layout(spark, sf_dir):
    return _clustered_lineitem(spark, sf_dir)


def q_cluster_file_ranges(spark, sf_dir):
    """The layout itself, from the files read back: eight files or more, none reaching into another's range."""
    return overlapping_files(_clustered_lineitem(spark, sf_dir, min_files=8), CLUSTER_KEYS)


SKIP_KEYS = ["l_partkey", "l_orderkey"]
SKIP_FROM, SKIP_TO = 10, 20


def q_cluster_skipping(spark, sf_dir):
    """What the cluster layout saves a reader: a filter on a few parts over the same rows dealt round robin into eight
    files and clustered into eight or more, with the rows that each scan had to decode (its own count)."""
    lineitem = table(spark, sf_dir, "lineitem")
    few = F.col("l_partkey").between(SKIP_FROM, SKIP_TO)
    plain = scratch_path(spark, "dealt")
    overwrite_table(lineitem.repartition(8), plain)
    wanted = [df.where(few).select("l_orderkey", "l_partkey")
              for df in (read_table(spark, plain), _clustered_lineitem(spark, sf_dir, SKIP_KEYS, min_files=8))]
    (found, dealt), (same, opened) = (rows_scanned(df) for df in wanted)
    if found != same:
        raise RuntimeError(f"the layouts disagree: {found} and {same} rows")
    return wanted[1].agg(F.count(F.lit(1)).alias("rows"), F.min("l_orderkey").alias("first_order"), F.max("l_orderkey").alias("last_order")).select(
        "*", F.lit(dealt).cast("long").alias("decoded_of_dealt"), F.lit(2 * opened < dealt).alias("clustered_decodes_under_half"))


# --- composite flows --------------------------------------------------------------

def q_bronze_to_silver(spark, sf_dir):
    cfg = _silver_cfg(spark, _land_venues(spark, sf_dir))
    run_silver(spark, cfg)
    return read_table(spark, cfg.silver_path, text_partitions=("nation",))


def q_silver_to_gold(spark, sf_dir):
    scfg = _silver_cfg(spark, _land_venues(spark, sf_dir))
    run_silver(spark, scfg)
    gcfg = _gold_cfg(spark, scfg.silver_path)
    run_gold(spark, gcfg, as_of=AS_OF)
    return read_table(spark, gcfg.gold_path)


def q_stream_bronze_to_silver(spark, sf_dir):
    from tierkit.streaming.incremental import stream_bronze_to_silver

    cfg = _silver_cfg(spark, _land_venues(spark, sf_dir))
    stream_bronze_to_silver(spark, cfg, checkpoint=scratch_path(spark, "silver-stream-ckpt"))
    return read_table(spark, cfg.silver_path, text_partitions=("nation",))


def q_bronze_to_silver_enriched(spark, sf_dir):
    reference = Enrichment(_reference_table(spark, sf_dir, "n_nationkey"), ["nation", "area_code"],
                           ["region_code", "region_name"])
    cfg = _silver_cfg(spark, _land_venues(spark, sf_dir), enrich=reference)
    run_silver(spark, cfg)
    return read_table(spark, cfg.silver_path, text_partitions=("nation",))


LANDED_AT = "20250101_120000_000000"


def q_land_snapshot(spark, sf_dir):
    """All records as one snapshot; its rows read back with what the landing committed."""
    root, wm = scratch_path(spark, "bronze"), scratch_path(spark, "bronze-wm")
    land_snapshot(venue_records(spark, sf_dir).drop("stamp"), root, wm, LANDED_AT)
    snap = newest_snapshot(spark, root)
    commit = rows_of(spark, commits_path(root), COMMIT_SCHEMA).first()
    scan = read_snapshots(spark, root, RECORD_SCHEMA, stamp_col=STAMP_COL, folders=snap.folders)
    return scan.select("line", STAMP_COL, F.lit(commit["rows"]).cast("long").alias("committed_rows"),
                       F.lit(read_watermark(spark, wm)).alias("watermark"))


def q_run_all(spark, sf_dir):
    """C4: records -> landed snapshot -> silver -> gold, in one call."""
    scfg = _silver_cfg(spark, scratch_path(spark, "bronze"))
    gcfg = _gold_cfg(spark, scfg.silver_path)
    run_all(spark, venue_records(spark, sf_dir).drop("stamp"), scratch_path(spark, "bronze-wm"), scfg, gcfg,
            as_of=AS_OF, stamp=LANDED_AT)
    return read_table(spark, gcfg.gold_path)


def _land_file_names(spark, sf_dir) -> str:
    """Venue records as one file per day, ``<day folder>/venues_<STAMP>.json``; the first day's file has
    no stamp in its name.  Spark names its own files, so the day's one file is renamed."""
    root = scratch_path(spark, "files")
    recs = venue_records(spark, sf_dir).withColumn("day", F.col("stamp"))
    recs.repartition("day").write.partitionBy("day").options(**JSON_KEEP_NULLS).json(root)
    path, fs = hadoop_path(spark, f"{root}/day=*/part-*.json")
    files = sorted(st.getPath().toString() for st in fs.globStatus(path))
    for i, f in enumerate(files):  # one file per day
        stamp = re.search(r"day=([0-9_]+)/", f)[1]
        day = f"{root}/y/{stamp[:4]}/{stamp[4:6]}/{stamp[6:8]}"
        target, _ = hadoop_path(spark, f"{day}/venues_{stamp if i else 'latest'}.json")
        fs.mkdirs(target.getParent())
        fs.rename(hadoop_path(spark, f)[0], target)
    return f"{root}/y"


def q_scan_file_names(spark, sf_dir):
    scan = read_snapshots(spark, _land_file_names(spark, sf_dir), RECORD_SCHEMA, layout="file_name", stamp_col=STAMP_COL)
    return scan.select("line", "label", STAMP_COL)


def q_bronze_to_silver_file_names(spark, sf_dir):
    cfg = _silver_cfg(spark, _land_file_names(spark, sf_dir), layout="file_name")
    run_silver(spark, cfg)
    return read_table(spark, cfg.silver_path, text_partitions=("nation",))


WORKLOADS = {
    "scan_json_snapshots": q_scan_json_snapshots,
    "land_json_partitioned": q_land_json_partitioned,
    "scan_csv_reference": q_scan_csv_reference,
    "paged_records": q_paged_records,
    "watermark_roundtrip": q_watermark_roundtrip,
    "gold_sql_view": q_gold_sql_view,
    "watermark_filter": q_watermark_filter,
    "max_stamp_since": q_max_stamp_since,
    "max_stamp_all": q_max_stamp_all,
    "latest_snapshot": q_latest_snapshot,
    "first_per_key": q_first_per_key,
    "norm_text": q_norm_text,
    "text_or_unknown": q_text_or_unknown,
    "slug": q_slug,
    "fold_slug": q_fold_slug,
    "fold_slug_sql": q_fold_slug_sql,
    "try_double": q_try_double,
    "regexp_extract_stamp": q_regexp_extract_stamp,
    "stamp_format": q_stamp_format,
    "date_parts": q_date_parts,
    "json_roundtrip": q_json_roundtrip,
    "silver_normalize": q_silver_normalize,
    "filter_eq_select": q_filter_eq_select,
    "preview_head": q_preview_head,
    "row_count": q_row_count,
    "empty_guard": q_empty_guard,
    "group_count": q_group_count,
    "audit_columns": q_audit_columns,
    "enrich_left": q_enrich_left,
    "table_overwrite_roundtrip": q_table_overwrite_roundtrip,
    "gold_table_roundtrip": q_gold_table_roundtrip,
    "csv_export_partitioned": q_csv_export_partitioned,
    "csv_export_plain": q_csv_export_plain,
    "cluster_layout": q_cluster_layout,
    "cluster_skipping": q_cluster_skipping,
    "cluster_file_ranges": q_cluster_file_ranges,
    "bronze_to_silver": q_bronze_to_silver,
    "silver_to_gold": q_silver_to_gold,
    "stream_bronze_to_silver": q_stream_bronze_to_silver,
    "bronze_to_silver_enriched": q_bronze_to_silver_enriched,
    "bronze_to_silver_file_names": q_bronze_to_silver_file_names,
    "scan_file_names": q_scan_file_names,
    "silver_sql": q_silver_sql,
    "land_snapshot": q_land_snapshot,
    "run_all": q_run_all,
}
