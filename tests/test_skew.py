"""One key holding a third of the rows: the hot group is split, never one task."""

import contextlib
import os
import re

from pyspark.sql import functions as F

from tierkit.operators.dedup import first_per_key
from tierkit.operators.enrich import enrich_left
from tierkit.sinks.files import overwrite_table
from tierkit.sinks.versions import current_path

SMALL = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "16",
}


@contextlib.contextmanager
def conf(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _skewed(spark, n=600_000):
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 50).cast("string"))
    return spark.range(n).select(key.alias("country"), "id",
                                 F.sha2(F.col("id").cast("string"), 256).alias("pad"))


def test_enrich_shuffle_splits_hot_key(spark):
    with conf(spark, SMALL):
        facts = _skewed(spark).withColumn(
            "country", F.when(F.col("id") % 5 == 1, F.lit(None)).otherwise(F.col("country")))
        ref = spark.range(50).select(F.col("id").cast("string").alias("country"),
                                     (F.col("id") * 2).alias("attr")).union(
            spark.createDataFrame([("hot", 999)], "country string, attr bigint"))
        out = enrich_left(facts, ref, ["country"], ["attr"], strategy="shuffle")
        qe = out._jdf.queryExecution()
        qe.toRdd().count()  # run this very plan, so AQE's final plan is recorded
        plan = qe.executedPlan().toString()
        rows = out.groupBy((F.col("attr") == 999).alias("hot")).count().collect()
    assert "skew=true" in plan
    assert len(re.findall(r"Range \(0, 600000", plan.split("Initial Plan")[0])) == 1  # one pass over the facts
    counts = {r.hot: r["count"] for r in rows}
    assert sum(counts.values()) == 600_000 and counts[True] == 160_000


def test_partitioned_write_splits_hot_partition(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "t")
    with conf(spark, SMALL):
        overwrite_table(_skewed(spark), p, ["country"])
    top = current_path(spark, p)
    files = lambda c: [f for f in os.listdir(os.path.join(top, f"country={c}"))
                       if f.endswith(".parquet")]
    assert len(files("hot")) > len(files("7"))
    assert spark.read.parquet(top).count() == 600_000


def test_first_per_key_hot_key(spark):
    with conf(spark, SMALL):
        out = first_per_key(_skewed(spark), ["country"], [F.col("id").desc()], [F.col("pad")])
        got = {r.country: r.id for r in out.collect()}
    assert got["hot"] == 599_997 and len(got) == 51
