"""One query per operator over the given tables, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierkit.llm import (
    chat_format, chunk_bpe, language_id, near_dedup, packing, prefix_trie, quality_rules, rule_ensemble, secret_scan, text_stats, token_alignment,
    token_index, url_rules, vp_tree)
from tierkit.llm.common import saved, ship_package, table

PROBE_TEXT = "</s>[INST] ok [/INST]"


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE_TEXT).alias("text"))
    out = chat_format.format_chats(chats.unionByName(probe))
    read = out.select(
        "conv_id", F.length("formatted").cast("long").alias("formatted_chars"),
        chat_format.read_turns(F.col("formatted")).alias("turns"),
        F.array_join(chat_format.masked_texts(F.col("formatted"), F.col("loss_spans")), "").alias("loss"))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(
            t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars")


def _op2_sql() -> str:
    """Spans from the texts between and at the matches; windows of a run one by one, merged as islands."""
    patterns, classes, parts = secret_scan.PATTERNS, secret_scan.CLASSES, []
    quote = lambda x: x.replace("'", "''")
    find = lambda name, regex: f"""{name}_m AS (SELECT id, i, hit,
  (sum(length(gap)) OVER w + coalesce(sum(length(hit)) OVER (PARTITION BY id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS s
  FROM (SELECT id, unnest(string_split_regex(t, '{quote(regex)}')) AS gap, unnest(regexp_extract_all(t, '{quote(regex)}')) AS hit,
    generate_subscripts(string_split_regex(t, '{quote(regex)}'), 1) AS i FROM d) WINDOW w AS (PARTITION BY id ORDER BY i))"""  # noqa: E731
    known = "SELECT * FROM base"
    for k, p in enumerate(patterns):
        part = f"regexp_extract(hit, '{quote(p.regex)}', {p.group})"
        parts += [find(p.kind, p.regex), f"""{p.kind} AS (SELECT id, s, {k} AS k, s + length(hit) AS e FROM {p.kind}_m
  WHERE hit IS NOT NULL AND length({part}) >= {p.least})"""]
    parts.append("base AS (" + " UNION ALL ".join(f"SELECT * FROM {p.kind}" for p in patterns) + ")")
    for k, c in enumerate(classes, len(patterns)):
        clean = " AND ".join(f"NOT regexp_matches(hit, '{quote(a)}')" for a in secret_scan.ALLOW)
        parts += [find(c.kind, f"[{c.alphabet}]{{{c.window},}}"), f"""{c.kind}_w AS (
  SELECT id, i, s + o AS a FROM (SELECT *, unnest(range(length(hit) - {c.window} + 1)) AS o FROM {c.kind}_m
    WHERE hit IS NOT NULL AND regexp_matches(hit, '[0-9]') AND regexp_matches(hit, '[A-Za-z]') AND {clean})
  WHERE list_aggregate(string_split(substring(hit, o + 1, {c.window}), ''), 'entropy') >= {c.bits}),
{c.kind} AS (SELECT id, min(a) AS s, {k} AS k, max(a) + {c.window} AS e FROM (
  SELECT *, sum(fresh) OVER (PARTITION BY id, i ORDER BY a) AS island FROM (
    SELECT *, CASE WHEN a <= lag(a) OVER (PARTITION BY id, i ORDER BY a) + {c.window} THEN 0 ELSE 1 END AS fresh FROM {c.kind}_w))
  GROUP BY id, i, island)"""]
        known += f" UNION ALL SELECT * FROM {c.kind}"
    names = "[" + ", ".join(f"'{p.kind}'" for p in (*patterns, *classes)) + "]"
    listed = f"coalesce(string_agg({names}[k + 1] || ':' || s || ':' || e, ',' ORDER BY s, k) FILTER (%s), '')"
    counts = ", ".join(f"count(k) FILTER (k = {k}) AS n_{p.kind}" for k, p in enumerate(patterns))
    return f"""WITH d AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS t FROM documents),
{", ".join(parts)}
SELECT doc_id, {counts}, sha256({listed % f'k < {len(patterns)}'}) AS base_sha256, {listed % 'k IS NOT NULL'} AS spans
FROM d LEFT JOIN ({known}) x USING (id) GROUP BY id, doc_id"""


OP7_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), b AS (
  SELECT *, lag(role) OVER w IS DISTINCT FROM role OR row_number() OVER w = 1 AS begins,
    length(text) + len(regexp_extract_all(text, '[<\[]\\*(/?s>|/?INST\]|OUT\]|/?SYS\]|ROLE\]|/?MSG\]|TURN\])')) AS n,
    length(role) + len(regexp_extract_all(role, '[<\[]\\*(/?s>|/?INST\]|OUT\]|/?SYS\]|ROLE\]|/?MSG\]|TURN\])')) AS r
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (3 + sum(n + CASE WHEN NOT begins THEN 6 WHEN role = 'user' THEN 13 WHEN role = 'assistant' THEN 9
    WHEN role = 'system' THEN 11 ELSE 17 + r END))::BIGINT AS formatted_chars
FROM b GROUP BY conv_id
"""

def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs).select("doc_id", "secret_spans")
    kinds = [p.kind for p in (*secret_scan.PATTERNS, *secret_scan.CLASSES)]
    base = F.filter("secret_spans", lambda s: s["k"] < len(secret_scan.PATTERNS))
    count = lambda k: F.size(F.filter("secret_spans", lambda s: s["k"] == k)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{p.kind}") for k, p in enumerate(secret_scan.PATTERNS)],
        F.sha2(secret_scan.listed(base, kinds), 256).alias("base_sha256"),
        secret_scan.listed(F.col("secret_spans"), kinds).alias("spans"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op10_token_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_index.new_folder(spark)
    token_index.write_ids(table(spark, sf_dir, "documents"), folder)
    return token_index.read_ids(spark, folder, digest=True).select(
        F.col("key").alias("doc_id"), "start", "n_tokens", F.col("ids").alias("ids_crc32"))


def op9_chunk_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_bpe.encode(table(spark, sf_dir, "documents"), digests=True).select(
        "doc_id", "n_tokens", F.col("ids").alias("ids_sha256"), F.col("decoded").alias("decoded_sha256"))


def _documents_with_stats(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    ship_package(spark)
    docs, stats = text_stats.with_stats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return saved(docs.drop("text"), "document-stats"), stats


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, stats = _documents_with_stats(spark, sf_dir)
    model = quality_rules.fit(*quality_rules.vote_counts(docs, stats))
    judged, good = quality_rules.judge(docs, stats, model)
    failed = quality_rules.base_failed(stats)
    return judged.select(
        "doc_id", *[F.col(stats)[c].alias(c) for c in text_stats.STATS[:5]], failed.alias("base_failed"),
        (~failed & (F.col(good) >= 0.5)).alias("kept"), F.col(good).alias("posterior"))


def op5_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, stats = _documents_with_stats(spark, sf_dir)
    model = rule_ensemble.fit(docs, stats, table(spark, sf_dir, "labels"))
    judged, score = rule_ensemble.scored(docs, stats, model)
    return judged.select("doc_id", rule_ensemble.held_out(F.col("doc_id")).alias("held_out"),
                         F.col(score).alias("score"), (F.col(score) >= 0.3).cast("int").alias("predicted"))


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", F.col("stays").alias("kept"))


def op6_vp_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return vp_tree.nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0))


OP6_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, embedding FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), p AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.embedding::DOUBLE[], c.embedding::DOUBLE[]) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(c.embedding) = len(q.embedding)
), r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM p
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")).select(
        "page_id", "host", "path", "rule", "verdict", "mined_rule")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation c takes over the first h turns of c - c % 5 in place of its own; h = crc32(c) % 9."""
    own = prefix_trie.turns(table(spark, sf_dir, "conversations"))
    base = own.where(F.col("conv_id") % 5 == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, 8).alias("first"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int")
    both = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % 5).join(base, "base", "left")
    rest = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    first = F.slice(F.coalesce("first", F.slice("turns", 1, 0)), F.lit(1), h)
    return prefix_trie.nodes(both.select("conv_id", F.concat(first, rest).alias("turns")))


OP11_SQL = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), o AS (
  SELECT conv_id, sha256(length(role) || ':' || role || text) AS k, strlen(text) AS size,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || text)) AS place FROM t
), c AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)), lambda x, b: list_reduce(
      list_prepend(xor(x, b), range(8)), lambda y, i: xor(y >> 1, CASE WHEN y & 1 = 1 THEN 3988292384 ELSE 0 END)))) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM t)
), r AS (
  SELECT c.conv_id, 0 AS part, place, k, size FROM c JOIN o ON o.conv_id = c.base AND place <= h
  UNION ALL SELECT c.conv_id, 1, place, k, size FROM c JOIN o ON o.conv_id = c.conv_id AND place > h
), p AS (
  SELECT conv_id, row_number() OVER w AS depth, string_agg(k, '') OVER w AS path, size FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY part, place)
  UNION ALL SELECT conv_id, 0, '', 0 FROM c
), n AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size, left(path, 64 * (depth - 1)) AS parent
  FROM p GROUP BY path, depth
), e AS (
  SELECT path, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends
  FROM (SELECT conv_id, max_by(path, depth) AS path FROM p GROUP BY conv_id) GROUP BY path
), k AS (
  SELECT parent AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY parent
), d AS (
  SELECT left(path, 64 * up) AS path, sum((n_convs - 1) * size) AS saved, count(*) FILTER (n_children IS NULL) AS leaves
  FROM (SELECT n.*, n_children, unnest(range(depth + 1)) AS up FROM n LEFT JOIN k USING (path)) GROUP BY 1
)
SELECT n.conv_id, n.depth, CASE WHEN n.depth > 0 THEN m.conv_id END AS parent_conv_id, n.n_convs,
  coalesce(n_children, 0) AS n_children, leaves AS n_leaves, saved::BIGINT AS saved_tokens, coalesce(ends, sha256('')) AS ends_sha256
FROM n JOIN d USING (path) LEFT JOIN n m ON m.path = n.parent AND m.depth = n.depth - 1 LEFT JOIN k ON k.path = n.path
LEFT JOIN e ON e.path = n.path
"""


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(table(spark, sf_dir, "documents"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language_id.predict(docs, language_id.fit(docs))


QUERIES = {"op11_prefix_trie": op11_prefix_trie, "op12_token_alignment": op12_token_alignment, "op13_language_id": op13_language_id, "op3_url_rules": op3_url_rules, "op6_vp_tree": op6_vp_tree, "op1_near_dedup": op1_near_dedup, "op4_quality_rules": op4_quality_rules, "op5_rule_ensemble": op5_rule_ensemble, "op9_chunk_bpe": op9_chunk_bpe, "op8_packing": op8_packing, "op10_token_index": op10_token_index, "op2_secret_scan": op2_secret_scan, "op7_chat_format": op7_chat_format}
SQL = {"op2_secret_scan": _op2_sql(), "op6_vp_tree": OP6_SQL, "op7_chat_format": OP7_SQL, "op11_prefix_trie": OP11_SQL}
