"""Plan shape of the registered queries: pushdown, pruning, partial
aggregation, top-k, bounded broadcasts, no row-at-a-time Python, no cross
joins.  Plans are taken on sf0.001; their shape does not depend on the size."""

import pytest

import __spark_entry__ as E
from conftest import SF001

# queries that only read (the others write a table first and return its read-back)
READ_ONLY = ["max_stamp_all", "first_per_key", "norm_text", "text_or_unknown", "slug", "fold_slug",
             "fold_slug_sql", "try_double", "regexp_extract_stamp", "stamp_format",
             "date_parts", "json_roundtrip", "silver_normalize", "filter_eq_select",
             "preview_head", "row_count", "group_count", "audit_columns", "enrich_left",
             "gold_sql_view", "paged_records"]


def _plan(spark, name):
    df = E.queries()[name](spark, SF001)
    qe = df._jdf.queryExecution()
    return (qe.executedPlan().toString(),
            df._sc._jvm.PythonSQLUtils.explainString(qe, "formatted"))


def _read_schemas(formatted):
    return [line.split("ReadSchema:")[1].strip() for line in formatted.splitlines()
            if line.strip().startswith("ReadSchema:")]


@pytest.mark.parametrize("name", READ_ONLY)
def test_no_row_python_no_cross_join(spark, name):
    plan, _ = _plan(spark, name)
    assert "BatchEvalPython" not in plan          # row-at-a-time Python UDF
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_filter_pushed_and_columns_pruned(spark):
    plan, formatted = _plan(spark, "filter_eq_select")
    assert "EqualTo(c_mktsegment,AUTOMOBILE)" in plan
    assert _read_schemas(formatted) == ["struct<c_custkey:bigint,c_name:string,c_mktsegment:string>"]


def test_row_count_reads_no_column(spark):
    plan, formatted = _plan(spark, "row_count")
    assert _read_schemas(formatted) == ["struct<>"]
    assert "partial_count" in plan


def test_max_stamp_partial_and_pruned(spark):
    plan, formatted = _plan(spark, "max_stamp_all")
    assert _read_schemas(formatted) == ["struct<ts:timestamp_ntz>"]
    assert plan.index("Exchange SinglePartition") < plan.index("partial_max")


def test_preview_is_top_k_not_a_sort(spark):
    plan, _ = _plan(spark, "preview_head")
    assert "TakeOrderedAndProject(limit=5" in plan
    assert "rangepartitioning" not in plan


def test_group_count_pre_aggregates_before_shuffle(spark):
    plan, _ = _plan(spark, "group_count")
    exchange = plan.index("Exchange hashpartitioning(nation")
    assert exchange < plan.index("partial_count")
    # the 25-row nation side is broadcast, customer is never shuffled for the join
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_latest_snapshot_broadcasts_only_the_one_row_max(spark):
    plan, _ = _plan(spark, "latest_snapshot")
    assert "SortMergeJoin" not in plan
    bcast = plan[plan.index("BroadcastExchange"):]
    assert "max(stamp" in bcast  # the broadcast side is the global aggregate


@pytest.mark.parametrize("name", ["watermark_filter", "max_stamp_since"])
def test_stamp_filter_prunes_snapshot_folders(spark, name):
    df = E.queries()[name](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(CASE" in plan or "PartitionFilters: [CASE" in plan, plan


def test_first_per_key_limits_before_shuffle(spark):
    plan, _ = _plan(spark, "first_per_key")
    exchange = plan.index("Exchange hashpartitioning")
    partial = plan.index("WindowGroupLimit", exchange)
    assert "Partial" in plan[partial:plan.index("\n", partial)]


def test_enrich_reference_is_checked_then_broadcast(spark):
    plan, _ = _plan(spark, "enrich_left")
    # the deduplicated reference (a checkpoint: ExistingRDD) is the broadcast side
    assert "BroadcastHashJoin" in plan and "LeftOuter" in plan
    assert "ExistingRDD" in plan[plan.rindex("BroadcastExchange"):]


def test_text_functions_stay_in_codegen(spark):
    plan, _ = _plan(spark, "slug")
    assert "Exchange" not in plan and "Python" not in plan
    assert plan.lstrip().startswith("*(")  # whole-stage code generation
