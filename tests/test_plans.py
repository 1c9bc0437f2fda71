"""What the physical plans must and must not hold."""

import contextlib
import io

import pytest

import __spark_entry__ as entry
from doclake.operators import guide as G
from doclake.operators import indexes as I
from doclake.queries.documents import event_docs, line_docs, table, text_docs
from doclake.queries.loading import _counter

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("name", [
    "array_view", "array_view_refresh", "path_index", "multivalue_index", "text_index", "flatten", "data_guide",
    "index_plan", "mat_paths", "counter_rate", "progress", "collection_report", "unique_violations", "read_bson",
    "bucket_counts", "size_rollup", "collection_option", "load_counters", "text_index_stream",
])
def test_no_cross_join_and_no_single_task(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    # One task may hold aggregates of the whole, never the rows: windows always have keys.
    for line in plan.splitlines():
        if "Exchange" in line and "SinglePartition" in line:
            assert "Window" not in plan


def test_range_scan_is_pushed_down(spark):
    plan = plan_of(entry.queries()["range_scan"](spark, SF))
    assert "GreaterThanOrEqual(o_orderkey" in plan and "LessThan(o_orderkey" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan


@pytest.mark.parametrize("make", [
    lambda s: I.spatial_index(event_docs(s, SF), "loc"),
    lambda s: I.multivalue_index(line_docs(s, SF), "charges.amount", "number", {"charges"}),
    lambda s: I.text_index(text_docs(s, SF), 1),
    lambda s: G.data_guide(line_docs(s, SF), max_depth=3),
    lambda s: I.array_view(line_docs(s, SF), [("status", "string"), ("charges.amount", "number")], {"charges"}),
])
def test_documents_are_parsed_once(spark, make):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        make(spark).explain()
    assert out.getvalue().count("parseJson") == 1


def test_sampling_is_a_distributed_top_n(spark):
    assert "TakeOrderedAndProject" in plan_of(entry.queries()["sample_first"](spark, SF))


def test_guide_shuffles_only_aggregates(spark):
    plan = plan_of(G.data_guide(line_docs(spark, SF), max_depth=3))
    first = plan[:plan.index("(1) ")]
    assert first.count("Exchange") <= 3  # spreading the small test input, two aggregates
    assert first.count("partial") == 0 or "Aggregate" in first


def test_small_inputs_are_spread_and_large_ones_are_not(spark):
    from doclake.runtime import spread

    assert spread(table(spark, SF, "orders")).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(0, 1000, 1, 50)
    assert spread(many) is many


def test_running_values_never_window_a_whole_counter(spark):
    plan = plan_of(_counter(spark, SF))
    assert "event_type" in plan and "_b" in plan


@pytest.mark.parametrize("keys", [[7], [3, 3, 3, 9], [None, None], [-(10**12), 0, None, 5, 10**15, 10**15 + 1], list(range(0, 30000, 3)) + [1] * 20000])
def test_key_at_share(spark, keys):
    from math import ceil

    from doclake.plans.ranges import key_at_share

    df, there = spark.createDataFrame([(k,) for k in keys], "id bigint"), sorted(k for k in keys if k is not None)
    for share in (0.0, 0.25, 0.5, 1.0):
        want = there[max(0, ceil(share * len(there)) - 1)] if there else None
        assert key_at_share(df, "id", share, cap=16) == want
