"""The physical plans the batch queries are meant to have."""

import re

import pytest
from pyspark.sql import functions as F

from footfall.operators import anchored_alerts
from footfall.plans.catalog import QUERIES, events

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(text: str) -> int:
    return len(re.findall(r"(?<!Reused)(?<!Broadcast)Exchange (?:hash|range|Round|Single)", text))


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan(query(spark, SF)) for name, query in QUERIES.items()}


def test_no_pairing_of_all_rows_and_no_python(plans):
    for name, text in plans.items():
        for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "FlatMapGroups"):
            assert node not in text, name


def test_filters_and_columns_reach_the_scan(plans):
    text = plans["hot_items"]
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,view)]" in text
    assert "FileScan parquet [ts" in text and "event_id" not in text and "user_id" not in text
    assert "FileScan parquet [ts" in plans["page_views"] and "props" not in plans["page_views"]


@pytest.mark.parametrize(
    "name, count",
    [
        ("page_views", 1),
        ("unique_visitors", 2),
        ("unique_visitors_sketch", 1),
        ("order_status", 1),
        ("click_cap", 1),
        ("reconcile", 1),
        ("fail_anchor", 1),
        ("channel_counts", 2),
        ("hot_items", 3),
    ],
)
def test_shuffles(plans, name, count):
    assert shuffles(plans[name]) == count, plans[name]


@pytest.mark.parametrize("name", ["hot_items", "hot_items_sql", "hot_pages", "click_cap", "click_blacklist"])
def test_ranks_are_limited_before_the_shuffle(plans, name):
    assert re.search(r"WindowGroupLimit .* Partial", plans[name])


@pytest.mark.parametrize("name", ["signup_purchase", "funnel_three_steps", "fail_pairs_strict", "fail_times2_global", "late_split"])
def test_orders_over_cuts_read_them_and_broadcast_what_crosses_an_edge(plans, name):
    """The table itself is read when it is cut; then rows are shuffled by cut, never by key alone."""
    text = plans[name]
    assert "events.parquet" not in text and "SortMergeJoin" not in text
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
    assert keys and all(re.match("_cut|_at|_k0", k) for k in keys), keys  # _k0 is a key of summaries


def test_reconcile_reads_each_side_once(plans):
    assert len(re.findall(r"FileScan", plans["reconcile"])) == 2


def test_counts_hash_and_combine_before_the_shuffle(plans):
    for name in ("page_views", "channel_counts"):
        assert "HashAggregate" in plans[name] and "partial_" in plans[name] and "SortAggregate" not in plans[name]


@pytest.mark.parametrize("split", [dict(block="1 day"), dict(hot_rows=10)])
def test_blocked_rows_are_shuffled_once(spark, split):
    df = anchored_alerts(events(spark, SF), ["user_id"], "event_time", "event_id", F.col("event_type") == "error", "1 hour", **split)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert re.search(r"ReusedExchange \[user_id", final)
