"""Physical plans of the registered queries: no cross joins, no Python, filters and columns at the scan."""

import re

import pytest

from statledger.checks import queries
from statledger.sources import colocated

FOLDER = "/root/testdata/sf0.001"
QUERIES = queries.queries()


def plan_of(spark, name):
    return QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream_")))
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(spark, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "MapInPandas"):
        assert bad not in plan


def test_time_windows_reach_the_scan(spark):
    plan = plan_of(spark, "recent_events")
    assert "GreaterThan(ts,2024-01-24T02:24)" in plan


def test_only_used_columns_are_read(spark):
    plan = plan_of(spark, "usage_share")
    read = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert read and all("l_extendedprice" not in columns and "l_orderkey" not in columns for columns in read)


def test_bounds_are_aggregated_before_the_shuffle(spark):
    plan = plan_of(spark, "job_bounds")
    assert "partial_stddev_pop" in plan and plan.count("Exchange hashpartitioning") == 1


def test_without_hot_keys_one_window_remains(spark):
    df = QUERIES["batch_delta"](spark, FOLDER)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("Window [") == 1 and "Union" not in final


def test_intervals_meet_their_restart_in_the_join_itself(spark):
    plan = plan_of(spark, "file_io_continue")
    join = next(line for line in plan.splitlines() if "Join" in line and "__cell" in line)
    assert re.search(r"report_date_time_start#\d+ >= __epoch", join) and re.search(r"report_date_time_end#\d+ < __end", join)


def test_co_located_tables_join_without_a_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(spark, "tables_with_statistics_co_located")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("SortMergeJoin") == 2 and "Exchange" not in plan and plan.count("Bucketed: true") == 3


def test_buckets_follow_the_rows(spark, monkeypatch):
    """A join over buckets has a task for each, so their number grows with the largest table."""
    tables = spark.range(10), spark.range(6001)
    assert colocated.buckets_for(*tables) == 8
    monkeypatch.setattr(colocated, "BUCKET_ROWS", 500)
    assert colocated.buckets_for(*tables) == 13
    dealt, lay_out = [], queries.co_locate
    monkeypatch.setattr(queries, "co_locate", lambda *a, buckets: dealt.append(buckets) or lay_out(*a, buckets=buckets))
    plan_of(spark, "tables_with_statistics_co_located")
    assert dealt == [12] * 3  # of 6,000 lines


def test_rebuild_worklist_reads_each_source_once(spark):
    df = QUERIES["rebuild_worklist"](spark, FOLDER)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    from_sources = re.findall(r"Location: InMemoryFileIndex\(\d+ paths?\)\[file:/root/testdata", final)
    assert len(from_sources) <= 4  # usage and row counts of the week, one scan each, are stored before


@pytest.mark.parametrize("name, most", [("enrich_candidates", 3), ("rebuild_commands", 2)])
def test_candidates_do_not_read_usage_again(spark, name, most):
    """Statistics, fragmentation and free space of the tables; free space and use of the indexes."""
    assert 0 < len(re.findall(r"Location: InMemoryFileIndex\(\d+ paths?\)\[file:/root/testdata", plan_of(spark, name).split("Initial Plan")[0])) <= most


@pytest.mark.parametrize("name", ["index_usage_snapshot", "fragmentation_snapshot", "statistics_snapshot", "index_free_space"])
def test_catalogues_that_grow_are_not_broadcast(spark, name):
    plan = plan_of(spark, name)
    joins = [line for line in plan.splitlines() if re.search(r"\w+Join\b", line) and "object_id" in line]
    assert joins and all("SortMergeJoin" in line for line in joins)


def test_rows_of_indexes_are_shuffled_once(spark):
    plan = plan_of(spark, "index_usage_snapshot")
    assert plan.count("SortMergeJoin") == 2 and plan.count("Exchange hashpartitioning") == 4  # usage, both catalogues, and their join
