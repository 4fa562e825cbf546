"""The registered queries against their SQL, and the pipeline's stages."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

import corpus_pipeline  # noqa: E402
from oracle_check import TABLES, digest  # noqa: E402
from tierkit.llm import queries  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got, want = queries.QUERIES[name](spark, SF).toPandas(), con.sql(queries.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and len(got) == len(want)
    assert digest(got)[0] == digest(want)[0]


def test_one_query_for_each_operator():
    assert sorted(int(q[2:].split("_")[0]) for q in queries.QUERIES) == list(range(1, 14))


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.saved(stage(spark, docs, SF), f"test-{name}")
        assert docs.columns == columns and 0 < docs.count() <= before
        before = docs.count()
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert pieces.select("doc_id").distinct().count() == before


def test_pipeline_edge_rows(spark, docs, nothing):
    sf = SF
    for df in (docs, nothing):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, df, sf)
            assert out.columns == df.columns
            out.collect()
        corpus_pipeline.STAGES[-1][1](spark, df, sf).collect()
