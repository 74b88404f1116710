"""What Spark makes of the queries."""

import re

import pytest

from flowkit.catalog import QUERIES
from flowkit.catalog.registry import table
from flowkit.operators import joins, topk

FOLDER = "/root/testdata/sf0.001"
IN_PYTHON = {"route_and_score", "keyed_batch_infer", "fit_route_models"}


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("stream")])
def test_no_cross_join_and_no_needless_python(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    assert ("Python" in text) == (name in IN_PYTHON)


def exchanges(frame):
    return len(re.findall(r"Exchange \w+", plan(frame)))


@pytest.mark.parametrize(
    "name, shuffles", [("word_count", 1), ("char_total", 1), ("split_short_long", 1), ("aligned_count_sum", 1), ("value_counts", 1), ("tumbling_word_count", 1)]
)
def test_one_shuffle(spark, name, shuffles):
    assert exchanges(QUERIES[name](spark, FOLDER)) == shuffles


def test_filter_and_columns_reach_the_scan(spark, capsys):
    QUERIES["source_projection_filter"](spark, FOLDER).explain("formatted")
    text = capsys.readouterr().out
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThanOrEqual(o_orderdate" in text
    assert "IsNotNull(o_custkey)" in text
    assert "o_orderstatus" not in text


def test_lookup_sum_adds_up_before_it_joins(spark):
    text = plan(QUERIES["lookup_enrich_sum"](spark, FOLDER))
    join, scan = text.index("HashJoin"), text.index("FileScan")
    assert "HashAggregate" in text[join:scan]


def test_groups_are_cut_to_k_before_the_shuffle(spark):
    text = plan(topk.kth_value(table(spark, FOLDER, "part"), ["p_brand"], "p_size", 3))
    assert text.count("WindowGroupLimit") == 2


def test_copies_made_in_the_plan_are_not_broadcast(spark):
    lookup = spark.range(50_000).selectExpr("id AS k", "id * 2 AS v")
    text = plan(joins.lookup_join(spark.range(100), lookup, "id", "k", salts=64))
    assert "Broadcast" not in text and "SortMergeJoin" in text


def test_one_scan_for_all_routes(spark):
    assert plan(QUERIES["partition_by_features"](spark, FOLDER)).count("FileScan") == 1
