"""Every query with SQL gives the rows DuckDB gives; the others give rows."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from tests.oracle import connect, difference

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, db, name):
    df = entry.queries()[name](spark, FOLDER)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert difference(df, db, sql) is None


# Queries whose plan changes when a group is too large for one task.
SPLIT = [
    "win_sequence_no", "win_running_offset", "win_truncate_to_length", "win_chunk_by_size", "win_chunk_by_size_strict",
    "win_chunk_islands", "win_merge_ranges", "win_merge_near_ranges", "win_resume_page", "win_hysteresis",
    "win_round_robin_buckets",
    "win_contiguous_buckets", "agg_group_by_key", "cogroup_merge", "sort_secondary_position", "hook_grouping",
    "win_prefer_healthy_k", "st_size_batches", "win_chunk_members", "win_chunk_cut_apart", "win_chunk_unpack",
]


@pytest.mark.parametrize("name", SPLIT)
def test_query_with_split_groups(spark, db, small_groups, name):
    spark.conf.set("spark.millrace.groupRows", "90")
    assert difference(entry.queries()[name](spark, FOLDER), db, entry.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", ["win_chunk_unpack", "audit_chunk_checksum"])
def test_query_with_groups_split_by_bytes(spark, db, name):
    spark.conf.set("spark.millrace.groupBytes", "60000")
    try:
        assert difference(entry.queries()[name](spark, FOLDER), db, entry.oracle_sql()[name]) is None
    finally:
        spark.conf.unset("spark.millrace.groupBytes")


# Queries that send a side to all tasks only after its size was checked.
CHECKED = [
    "filter_required", "filter_attempt_range", "filter_allowlist", "filter_denylist", "join_broadcast", "join_left_semi_ids",
    "route_by_huge_group", "audit_delivery", "st_quota",
]


@pytest.mark.parametrize("name", CHECKED)
def test_query_without_broadcast(spark, db, name):
    spark.conf.set("spark.millrace.broadcastRows", "0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert difference(entry.queries()[name](spark, FOLDER), db, entry.oracle_sql()[name]) is None
    finally:
        spark.conf.unset("spark.millrace.broadcastRows")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", ["join_salted", "join_skewed", "agg_word_count", "audit_complete", "win_dedupe_first"])
@pytest.mark.parametrize("setting, value", [("spark.sql.adaptive.enabled", "false"), ("spark.sql.shuffle.partitions", "200")])
def test_query_under_other_settings(spark, db, name, setting, value):
    before = spark.conf.get(setting)
    spark.conf.set(setting, value)
    try:
        assert difference(entry.queries()[name](spark, FOLDER), db, entry.oracle_sql()[name]) is None
    finally:
        spark.conf.set(setting, before)


def test_entry(spark):
    assert entry.entry(spark).columns == ["event_type", "n"]


@pytest.mark.parametrize("left_out", [["llm"], ["llm", "corpus_pipeline.py"]])
def test_entry_without_the_training_data_part(tmp_path, left_out):
    root = Path(entry.__file__).parent
    shutil.copytree(root / "millrace", tmp_path / "millrace", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in {"__spark_entry__.py", "corpus_pipeline.py"} - set(left_out):
        if (root / name).exists():
            shutil.copy(root / name, tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), any(n.startswith('op') or n == 'pipeline' for n in e.queries()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert out.stdout.split() == [str(len(entry.QUERIES)), "False"]
