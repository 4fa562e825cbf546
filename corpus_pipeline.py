"""The corpus pipeline: five stages over ``documents``, each calling one operator of ``tierkit.llm``.

Classifier and rules drop the documents that they reject, near-duplicate
detection keeps one of each class, the secret scan blanks out what it finds, and
the packing returns one row per piece. Every stage takes (spark, docs, sf_dir)
and all rows that the one before it kept; all but the last return the columns of
``documents``. ``run`` writes each stage's rows to the shared folder as
Parquet and gives them to the next.

Defined cases are those of the operators; an empty table runs through, and rows
with a null text are rejected as having fewer than ten words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierkit.llm import near_dedup, packing, quality_rules, rule_ensemble, secret_scan, text_stats
from tierkit.llm.common import fresh, saved, ship_package, table

LEAST_SCORE = 0.3  # of the quality classifier
LEAST_POSTERIOR = 0.5  # of the quality rules


def _with_stats(docs: DataFrame) -> tuple[DataFrame, str]:
    ship_package(docs.sparkSession)
    found, stats = text_stats.with_stats(docs)
    return saved(found, "stage-stats"), stats


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the rule ensemble scores ``LEAST_SCORE`` or more."""
    found, stats = _with_stats(docs)
    model = rule_ensemble.fit(found, stats, table(spark, sf_dir, "labels"))
    judged, score = rule_ensemble.scored(found, stats, model)
    return judged.where(F.col(score) >= LEAST_SCORE).select(*docs.columns)


def quality_votes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that pass the base rules and are probably good by the rules' votes."""
    found, stats = _with_stats(docs)
    model = quality_rules.fit(*quality_rules.vote_counts(found, stats))
    judged, good = quality_rules.judge(found, stats, model)
    return judged.where(~quality_rules.base_failed(stats) & (F.col(good) >= LEAST_POSTERIOR)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one with the smallest doc_id."""
    return near_dedup.keep_one(docs)


def secrets_blanked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret replaced by a mark, and n_chars set to the new length."""
    spans = fresh(docs, "secret_spans")
    found = secret_scan.scan(docs).withColumnRenamed("secret_spans", spans)
    clean = found.withColumn("text", F.when(F.col("text").isNotNull(), secret_scan.redact(F.col("text"), F.col(spans))))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.when(F.size(spans) > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return clean.select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences."""
    return packing.pack(docs)


STAGES = [("quality_classifier", quality_classifier), ("quality_rules", quality_votes),
          ("near_duplicates", near_duplicates), ("secret_scan", secrets_blanked), ("packing", packed)]
# The classifier is trained, and tokens come from a tokenizer: SQL can't express the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
