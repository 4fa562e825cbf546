"""DuckDB SQL oracles for ``tierkit.workloads`` (same column names).

Written independently of the Spark code: plain SQL over the driver's tables.
DuckDB notes: ``regexp_replace`` needs the ``'g'`` flag; ``trim(x, ' ')``
strips spaces only, like Spark's ``trim``.
"""

from __future__ import annotations

EPOCH = "19700101_000000_000000"
MID = "20240115_000000_000000"
AS_OF = "TIMESTAMP '2025-01-01 00:00:00'"


def _slug(x: str) -> str:
    return (f"regexp_replace(coalesce(nullif(lower(trim({x}, ' ')), ''), 'unknown'), "
            f"'[^a-z0-9]+', '_', 'g')")


def _text(x: str) -> str:
    return f"lower(trim({x}, ' '))"


def _unknown(x: str) -> str:
    return f"coalesce(nullif(lower(trim({x}, ' ')), ''), 'unknown')"


def _fold(x: str) -> str:
    inner = f"lower(regexp_replace(strip_accents({x}), '[^\\x00-\\x7F]', '', 'g'))"
    return (f"trim(regexp_replace(regexp_replace({inner}, '[^a-z0-9_]', '_', 'g'), "
            f"'_+', '_', 'g'), '_')")


DAY_STAMP = "strftime(ts, '%Y%m%d') || '_000000_000000'"
EV = f"(SELECT *, {DAY_STAMP} AS stamp FROM events)"

RECS = f"""recs AS (
  SELECT CAST(e.user_id AS VARCHAR) AS venue_key,
         'event ' || CAST(e.event_id AS VARCHAR) AS line,
         c.c_name AS label,
         c.c_mktsegment AS kind,
         e.event_type AS channel,
         CASE WHEN e.event_type = 'view' THEN NULL ELSE ' Floor ' || e.event_type || ' ' END AS floor,
         CAST(NULL AS VARCHAR) AS spare,
         n.n_name AS nation,
         CASE WHEN e.event_type = 'error' THEN '  ' ELSE n.n_name END AS area,
         CASE WHEN e.event_type = 'purchase' THEN NULL ELSE upper(n.n_name) END AS province,
         lpad(CAST(c.c_nationkey AS VARCHAR), 5, '0') AS area_code,
         e.value AS amount,
         CASE WHEN e.event_type = 'click' THEN NULL ELSE -e.value END AS opposite,
         e.props AS payload,
         strftime(e.ts, '%Y%m%d') || '_000000_000000' AS stamp
  FROM events e
  LEFT JOIN customer c ON e.user_id = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

SILVER_COLS = f"""
  trim(venue_key, ' ') AS venue_key, {_slug('nation')} AS nation, {_unknown('area')} AS area,
  {_unknown('province')} AS province, amount, opposite, {_text('line')} AS line, {_text('label')} AS label,
  {_text('kind')} AS kind, {_text('channel')} AS channel, {_text('floor')} AS floor, {_text('spare')} AS spare,
  {_text('area_code')} AS area_code, {_text('payload')} AS payload, stamp AS snapshot_stamp"""

SILVER_ALL = f"WITH {RECS} SELECT {SILVER_COLS} FROM recs"


def _silver_latest(recs: str = "recs", since: str = EPOCH) -> str:
    return f"""WITH {RECS},
latest AS (SELECT max(stamp) AS m FROM {recs} WHERE stamp > '{since}'),
snap AS (SELECT r.*, row_number() OVER (PARTITION BY r.venue_key ORDER BY r.line DESC) AS rn
         FROM {recs} r JOIN latest l ON r.stamp = l.m)
SELECT {SILVER_COLS} FROM snap WHERE rn = 1"""


SILVER_LATEST = _silver_latest()
# all records as one snapshot
SILVER_ONE = f"""WITH {RECS},
snap AS (SELECT *, row_number() OVER (PARTITION BY venue_key ORDER BY line DESC) AS rn FROM recs)
SELECT {SILVER_COLS} FROM snap WHERE rn = 1"""
REFERENCE = """(SELECT DISTINCT {slug} AS nation, lpad(CAST(n.{code} AS VARCHAR), 5, '0') AS area_code,
         upper(substr(r.r_name, 1, 2)) AS region_code, r.r_name AS region_name
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey WHERE r.r_regionkey < 4)"""


def _gold_over(silver_sql: str) -> str:
    return f"""SELECT nation, kind, count(venue_key) AS n_venues, {AS_OF} AS created_at, {AS_OF} AS updated_at
FROM ({silver_sql}) s GROUP BY nation, kind"""


GROUP_COUNT = f"""SELECT {_slug('n.n_name')} AS nation, {_text('c.c_mktsegment')} AS kind,
       count(c.c_custkey) AS n_venues
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY 1, 2"""

AUDIT = f"""SELECT *, {AS_OF} AS created_at, {AS_OF} AS updated_at FROM ({GROUP_COUNT}) g"""

ORACLES = {
    "scan_json_snapshots": f"WITH {RECS} SELECT * EXCLUDE (stamp), stamp AS snapshot_stamp FROM recs",
    "land_json_partitioned": """SELECT 'event ' || CAST(event_id AS VARCHAR) AS line,
       strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day,
       strftime(ts, '%Y%m%d') || '_000000_000000' AS snapshot FROM events""",
    "scan_csv_reference": """SELECT CAST(c_custkey AS VARCHAR) AS customer_key, c_name AS customer_name,
       lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS postal_code, c_mktsegment AS segment
FROM customer""",
    "paged_records": """SELECT c_custkey // 200 + 1 AS page, c_custkey, c_name, c_nationkey, c_acctbal,
       c_mktsegment FROM customer""",
    "watermark_roundtrip": f"""SELECT '{EPOCH}' AS absent_default,
       max(strftime(ts, '%Y%m%d')) || '_000000_000000' AS watermark FROM events""",
    "gold_sql_view": _gold_over(SILVER_ALL),
    "watermark_filter": f"SELECT event_id, user_id, stamp FROM {EV} e WHERE stamp > '{MID}'",
    "max_stamp_since": f"SELECT max(stamp) AS max_stamp FROM {EV} e WHERE stamp > '{MID}'",
    "max_stamp_all": f"SELECT max(stamp) AS max_stamp FROM {EV} e",
    "latest_snapshot": f"""SELECT event_id, user_id, stamp FROM {EV} e
WHERE stamp = (SELECT max(stamp) FROM {EV} e2)""",
    "first_per_key": """SELECT user_id, event_id, ts, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "norm_text": f"""SELECT doc_id, {_text('text')} AS text_norm, {_text("'  ' || lang || ' '")} AS lang_norm,
       {_text("CASE WHEN source = 'src0' THEN NULL ELSE source END")} AS source_norm FROM documents""",
    "text_or_unknown": f"""SELECT doc_id,
       {_unknown("CASE WHEN source = 'src1' THEN '   ' WHEN source = 'src2' THEN NULL ELSE lang END")}
         AS lang_or_unknown,
       {_unknown('text')} AS text_or_unknown FROM documents""",
    "slug": f"SELECT doc_id, {_slug('text')} AS text_slug, {_slug('source')} AS source_slug FROM documents",
    "fold_slug": f"SELECT doc_id, {_fold('text')} AS text_fold FROM documents",
    "fold_slug_sql": f"SELECT doc_id, {_fold('text')} AS text_fold FROM documents",
    "try_double": """SELECT event_id, raw, TRY_CAST(raw AS DOUBLE) AS parsed FROM (
  SELECT event_id, CASE event_type
    WHEN 'click' THEN CAST(event_id AS VARCHAR) || '.5'
    WHEN 'view' THEN ' ' || CAST(event_id AS VARCHAR) || ' '
    WHEN 'error' THEN 'x' || CAST(event_id AS VARCHAR)
    WHEN 'purchase' THEN ''
    ELSE CAST(event_id AS VARCHAR) || 'e-2' END AS raw FROM events) t""",
    "regexp_extract_stamp": r"""SELECT event_id, file_name,
       regexp_extract(file_name, '_(\d{8}_\d{6}_\d{6})\.json$', 1) AS stamp FROM (
  SELECT event_id, CASE WHEN event_type = 'error'
      THEN 'events_' || CAST(event_id AS VARCHAR) || '.json'
      ELSE 'events_' || strftime(ts, '%Y%m%d_%H%M%S_%f') || '.json' END AS file_name
  FROM events) t""",
    "stamp_format": "SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S_%f') AS stamp FROM events",
    "date_parts": """SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) AS year,
       lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') AS month,
       lpad(CAST(day(o_orderdate) AS VARCHAR), 2, '0') AS day FROM orders""",
    "json_roundtrip": """SELECT event_id,
       to_json({'event_id': event_id, 'user_id': user_id, 'event_type': event_type}) AS line,
       user_id AS user_id_back, event_type AS event_type_back,
       CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""",
    "silver_normalize": SILVER_ALL,
    "filter_eq_select": """SELECT c_custkey, c_name, c_mktsegment FROM customer
WHERE c_mktsegment = 'AUTOMOBILE'""",
    "preview_head": """SELECT c_custkey, c_name, c_acctbal FROM customer
ORDER BY c_acctbal DESC, c_custkey LIMIT 5""",
    "row_count": "SELECT count(*) AS row_count FROM lineitem",
    "empty_guard": """SELECT true AS nothing_newer,
       (SELECT count(*) = 0 FROM events) AS events_empty""",
    "group_count": GROUP_COUNT,
    "audit_columns": AUDIT,
    "enrich_left": f"""WITH ref AS {REFERENCE.format(slug=_slug('n.n_name'), code='n_regionkey')},
facts AS (
  SELECT c.c_custkey, {_slug('n.n_name')} AS nation,
         CASE WHEN c.c_mktsegment = 'MACHINERY' THEN NULL
              WHEN c.c_mktsegment = 'BUILDING' THEN '99999'
              ELSE lpad(CAST(n.n_regionkey AS VARCHAR), 5, '0') END AS area_code
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)
SELECT f.c_custkey, f.nation, f.area_code, r.region_code, r.region_name
FROM facts f LEFT JOIN ref r ON f.nation = r.nation AND f.area_code = r.area_code""",
    "table_overwrite_roundtrip": SILVER_ALL,
    "gold_table_roundtrip": AUDIT,
    "csv_export_partitioned": SILVER_ALL,
    "csv_export_plain": AUDIT,
    "cluster_layout": "SELECT * FROM lineitem",
    "cluster_skipping": """SELECT count(*) FILTER (l_partkey BETWEEN 10 AND 20) AS rows,
  min(l_orderkey) FILTER (l_partkey BETWEEN 10 AND 20) AS first_order,
  max(l_orderkey) FILTER (l_partkey BETWEEN 10 AND 20) AS last_order,
  count(*) AS decoded_of_dealt, TRUE AS clustered_decodes_under_half FROM lineitem""",
    "cluster_file_ranges": "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS overlapping_files FROM lineitem",
    "bronze_to_silver": SILVER_LATEST,
    "silver_to_gold": _gold_over(SILVER_LATEST),
    "stream_bronze_to_silver": SILVER_LATEST,
    "bronze_to_silver_enriched": f"""SELECT s.*, r.region_code, r.region_name FROM ({SILVER_LATEST}) s
LEFT JOIN {REFERENCE.format(slug=_slug('n.n_name'), code='n_nationkey')} r
  ON s.nation = r.nation AND s.area_code = r.area_code""",
    "bronze_to_silver_file_names": SILVER_LATEST,
    "scan_file_names": f"""WITH {RECS} SELECT line, label,
       CASE WHEN stamp = (SELECT min(stamp) FROM recs) THEN '' ELSE stamp END AS snapshot_stamp FROM recs""",
    "silver_sql": _silver_latest(since=MID),
    "land_snapshot": f"""WITH {RECS} SELECT line, '20250101_120000_000000' AS snapshot_stamp,
       (SELECT count(*) FROM recs) AS committed_rows, '20250101_120000_000000' AS watermark FROM recs""",
    "run_all": _gold_over(SILVER_ONE),
}
