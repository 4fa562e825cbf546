"""Driver contract: every registered workload equals its DuckDB oracle (sf0.001)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import TABLES, digest  # noqa: E402
from tierkit.oracles import ORACLES  # noqa: E402
from tierkit.workloads import WORKLOADS  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(WORKLOADS) == set(ORACLES)
    assert set(WORKLOADS) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(WORKLOADS))
def test_query_matches_oracle(spark, con, name):
    sp = E.queries()[name](spark, SF).toPandas()
    dk = con.sql(E.oracle_sql()[name]).df()
    assert sorted(sp.columns) == sorted(dk.columns)
    assert len(sp) == len(dk)
    assert digest(sp)[0] == digest(dk)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["nation", "kind", "n_venues", "created_at", "updated_at"]
    assert df.count() > 0
