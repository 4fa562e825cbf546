"""X1-X13, U1, U2 on the edge rows of FIXTURES.md plus property tests."""

import string

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tierkit.functions import text as T

EDGE = [
    # input, slug, fold (NULL -> NULL by default)
    ("Austria", "austria", "austria"),
    (" South Korea ", "south_korea", "south_korea"),
    ("Österreich", "_sterreich", "osterreich"),
    ("Côte d'Ivoire", "c_te_d_ivoire", "cote_d_ivoire"),
    ("__a__b__", "_a_b_", "a_b"),
    ("a_-_b", "a_b", "a_b"),
    ("U.S.A.", "u_s_a_", "u_s_a"),
    ("  ", "unknown", ""),
    ("", "unknown", ""),
    (None, "unknown", None),
    ("\tTab\t", "_tab_", "tab"),
    ("日本", "_", ""),
    ("ﬁnland ½ ²", "_nland_", "finland_12_2"),
    ("Straße", "stra_e", "strae"),
    ("İstanbul", "i_stanbul", "istanbul"),
]


@pytest.fixture(scope="module")
def edge_df(spark):
    return spark.createDataFrame([(e[0],) for e in EDGE], "x string")


def test_slug_edges(edge_df):
    got = [r.s for r in edge_df.select(T.slug("x").alias("s")).collect()]
    assert got == [e[1] for e in EDGE]


def test_fold_exact(edge_df):
    got = [r.s for r in edge_df.select(T.fold_slug("x").alias("s")).collect()]
    assert got == [e[2] for e in EDGE] == [T.fold_text(e[0]) for e in EDGE]


def test_fold_null_parity(edge_df):
    got = [r.s for r in edge_df.select(T.fold_slug("x", null_as_text=True).alias("s")).collect()]
    assert got[EDGE.index((None, "unknown", None))] == "none"


def test_text_rules(spark):
    df = spark.createDataFrame([(" A b ",), ("  ",), (None,), ("\tX",)], "x string")
    rows = df.select(T.norm_text("x").alias("t"), T.text_or_unknown("x").alias("u"),
                     T.norm_id("x").alias("i")).collect()
    assert [r.t for r in rows] == ["a b", "", None, "\tx"]
    assert [r.u for r in rows] == ["a b", "unknown", "unknown", "\tx"]
    assert [r.i for r in rows] == ["A b", "", None, "\tX"]


def test_try_double(spark):
    vals = ["1.5", " 1.5 ", "", "NaN", "1.5d", "x", None]
    df = spark.createDataFrame([(v,) for v in vals], "x string")
    got = [r.d for r in df.select(T.try_double("x").alias("d")).collect()]
    assert got[0] == 1.5 and got[1] == 1.5 and got[2] is None
    assert got[3] != got[3]  # NaN
    assert got[4] == 1.5 and got[5] is None and got[6] is None


def test_fold_sql_registration(spark):
    T.register_fold_udf(spark, "fold_slug_t")
    assert spark.sql("SELECT fold_slug_t('Côte d''Ivoire') AS s").first().s == "cote_d_ivoire"


def test_plan_slug_has_no_python(spark, edge_df):
    plan = edge_df.select(T.slug("x"))._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan


TEXT = st.text(alphabet=st.characters(blacklist_categories=("Cs",)), max_size=40)


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=20))
def test_fold_properties(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "x string")
    rows = df.select(T.fold_slug("x").alias("a"), T.slug("x").alias("s")).collect()
    allowed = set(string.ascii_lowercase + string.digits + "_")
    for x, r in zip(xs, rows):
        assert r.a == T.fold_text(x)
        assert set(r.s) <= allowed and set(r.a) <= allowed
        assert not r.a.startswith("_") and "__" not in r.a
        assert T.fold_text(r.a) == r.a  # idempotent


# The Arrow kernel alone (no Spark): equal to the per-row definition on any
# array - with NULLs, empty strings, runs of '_' across string boundaries, and
# on sliced and large-string arrays (offsets not starting at 0 / 64-bit).
@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT, st.text(alphabet="_ aÉ-ﬁ½", max_size=8)), max_size=30),
       st.integers(min_value=0, max_value=5))
def test_fold_arrow_kernel_equals_definition(xs, cut):
    import pyarrow as pa

    exp = [T.fold_text(x) for x in xs]
    arr = pa.array(xs, type=pa.string())
    assert T.fold_text_arrow(arr).to_pylist() == exp
    assert T.fold_text_arrow(arr.cast(pa.large_string())).to_pylist() == exp
    assert T.fold_text_arrow(arr.slice(cut)).to_pylist() == exp[cut:]


def test_fold_arrow_kernel_edges():
    import pyarrow as pa

    xs = [e[0] for e in EDGE]
    assert T.fold_text_arrow(pa.array(xs)).to_pylist() == [e[2] for e in EDGE]
    assert T.fold_text_arrow(pa.array([], pa.string())).to_pylist() == []
    assert T.fold_text_arrow(pa.array([None, None], pa.string())).to_pylist() == [None, None]
    assert T.fold_text_arrow(pa.array(["_", "", "__", "a_", "_b"])).to_pylist() == ["", "", "", "a", "b"]


def test_plan_arrow_fold_is_batched(spark, edge_df):
    plan = edge_df.select(T.fold_slug("x"))._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "BatchEvalPython" not in plan


def test_fold_arrow_kernel_slices(monkeypatch):
    import pyarrow as pa

    xs = ["Côte d'Ivoire " * 30, None, "", "ﬁ½__x", "a" * 500, "É-É"] * 40
    exp = [T.fold_text(x) for x in xs]
    whole = T.fold_text_arrow(pa.array(xs)).to_pylist()
    monkeypatch.setattr(T, "FOLD_SLICE_BYTES", 700)  # many slices, some rows longer than one
    assert T.fold_text_arrow(pa.array(xs)).to_pylist() == exp == whole
    assert T.fold_text_arrow(pa.array(xs).slice(7)).to_pylist() == exp[7:]


def test_fold_queries_send_small_batches(spark, tmpdir_path):
    """Whole texts go to the workers, few at a time: their memory doesn't grow with rows or their length."""
    from tierkit import workloads
    from tierkit.session import ARROW_BATCH_BYTES

    texts = ["Côte " * 100_000, None, "", "a_-_b"] * 6  # 600,000 bytes each, the long ones
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1).write.parquet(
        f"{tmpdir_path}/documents.parquet")
    for query in (workloads.q_fold_slug, workloads.q_fold_slug_sql):
        df = query(spark, tmpdir_path)
        assert {r.doc_id: r.text_fold for r in df.collect()} == {i: T.fold_text(t) for i, t in enumerate(texts)}
        size = df.sparkSession.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
        assert int(size.rstrip("b")) == ARROW_BATCH_BYTES <= 4 * 1024 * 1024
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("b") == str(64 * 1024 * 1024)


def test_fold_kernel_temporaries_stay_small():
    """Texts that lose most bytes: what the kernel holds beside them is a small part of them."""
    import tracemalloc

    import pyarrow as pa

    arr = pa.array(["한국어 日本 é" * 150] * 4000)
    tracemalloc.start()
    T.fold_text_arrow(arr)
    most = tracemalloc.get_traced_memory()[1]  # numpy's share
    tracemalloc.stop()
    assert most < arr.nbytes * 3


def test_fold_udf_code_travels_by_value(tmp_path):
    # a Python worker started anywhere (no tierkit on its path) can run the UDF body
    import subprocess
    import sys

    from pyspark import cloudpickle

    blob = tmp_path / "fold.pkl"
    blob.write_bytes(cloudpickle.dumps(T.fold_text_arrow))
    code = ("import pickle, sys, pyarrow as pa; f = pickle.load(open(sys.argv[1], 'rb')); "
            "print(f(pa.array(['Côte d\\'Ivoire', None])).to_pylist())")
    out = subprocess.run([sys.executable, "-c", code, str(blob)], cwd=tmp_path,
                         capture_output=True, text=True, env={"PATH": "/usr/bin:/bin"}, timeout=120)
    assert out.returncode == 0, out.stderr
    assert out.stdout.strip() == "['cote_d_ivoire', None]"
