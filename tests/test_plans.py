"""The plans Spark makes for the queries."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from millrace.operators import joins

FOLDER = "/root/testdata/sf0.001"


def plan(spark, name):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    return entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


def scans(text):
    return [re.sub(r"#\d+L?", "", c).split(",") for c in re.findall(r"FileScan parquet \[([^\]]*)\]", text)]


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(spark, "scan_parquet")
    assert "GreaterThanOrEqual(l_quantity,30.0)" in text and "EqualTo(l_returnflag,R)" in text
    assert scans(text) == [["l_orderkey", "l_partkey", "l_quantity", "l_returnflag"]]
    assert scans(plan(spark, "agg_count_by_key")) == [["event_type", "value"]]
    assert scans(plan(spark, "audit_complete")) == [["o_orderkey"], ["l_orderkey"]]


@pytest.mark.parametrize("name", [
    "win_dedupe_first", "win_first_good_replica", "win_tier_coalesce", "filter_required", "win_pick_attempt",
])
def test_keys_are_reduced_before_the_shuffle(spark, name):
    text = plan(spark, name)
    limit = text.rindex("WindowGroupLimit")
    assert "Exchange hashpartitioning" in text[:limit] and text.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("name", [
    "agg_count_by_key", "agg_word_count", "agg_quorum", "agg_group_sizes", "dataset_diff", "audit_delivery",
])
def test_aggregates_combine_before_the_shuffle(spark, name):
    assert "partial_" in plan(spark, name)


def test_one_exchange_suffices(spark):
    for name in ["win_dedupe_first", "win_running_offset", "win_chunk_by_size", "win_prefer_healthy_k", "agg_quorum"]:
        assert plan(spark, name).count("Exchange ") == 1, name


@pytest.mark.parametrize("name, join", [
    ("join_sort_merge", "SortMergeJoin"), ("join_shuffle_hash", "ShuffledHashJoin"), ("join_broadcast", "BroadcastHashJoin"),
    ("join_skewed", "SortMergeJoin"), ("join_left_semi_ids", "LeftSemi"), ("join_left_anti_missing", "LeftAnti"),
])
def test_join_strategies(spark, name, join):
    assert join in plan(spark, name)


def test_a_skewed_partition_is_split_at_run_time(spark):
    """With thresholds that small data reaches, the hot key's partition is read by several tasks."""
    low = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.files.maxPartitionBytes": "64k",
    }
    for key, value in low.items():
        spark.conf.set(key, value)
    try:
        # A partition is split between the map tasks that wrote it, so there must be several.
        left = spark.range(0, 60_000, 1, 8).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
        right = spark.range(0, 60_000, 1, 4).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
        joined = joins.join_smj(left, right, "k")
        rows = joined.collect()
        text = joined._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in text and "SortMergeJoin" in text
        assert len(rows) == 60_000 and all(r.w == 2 * r.k for r in rows)
    finally:
        for key in low:
            spark.conf.unset(key)


def test_no_products(spark):
    for name in ["join_salted", "join_skewed", "filter_allowlist", "win_resume_page", "audit_delivery", "agg_quorum_read_union"]:
        text = plan(spark, name)
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name


def test_limits_keep_few_rows_per_task(spark):
    assert "TakeOrderedAndProject" in plan(spark, "topk_largest")
    assert "Window" not in plan(spark, "route_by_huge_group")


def test_large_sides_are_not_broadcast(spark):
    spark.conf.set("spark.millrace.broadcastRows", "3")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in plan(spark, "join_broadcast")
    finally:
        spark.conf.unset("spark.millrace.broadcastRows")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
