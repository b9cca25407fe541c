"""Stored history: idempotent appends, point-in-time reads, retention, isolated sources, whole runs."""

from decimal import Decimal as D

import pytest
from frames import ts, tuples
from pyspark.sql import functions as F

from statledger.plans import runner
from statledger.sources import history, landed
from statledger.sources.schemas import TABLES, schema
from statledger.streaming import ingest

AT = "2024-01-31 00:00:00"


def rows(spark, n, db="d"):
    return spark.createDataFrame([(db, f"[dbo].[t{i}]", f"t{i}", i, ts(AT)) for i in range(n)], schema("table_rows"))


def test_every_table_has_a_schema(spark):
    assert len(TABLES) == 26 + 1  # the history tables, and one for alerts
    for name in TABLES:
        assert schema(name).fieldNames()


def test_rerun_replaces_its_own_rows_only(spark, tmp_path):
    root = str(tmp_path)
    history.append_snapshot(rows(spark, 3), root, "table_rows", "2024-01-30 02:00:00")
    history.append_snapshot(rows(spark, 5), root, "table_rows", "2024-01-30 04:00:00")
    history.append_snapshot(rows(spark, 2), root, "table_rows", "2024-01-30 02:00:00")
    assert history.read_history(spark, root, "table_rows").count() == 7
    assert history.read_history(spark, root, "table_rows", until="2024-01-30 03:00:00").count() == 2
    assert history.read_history(spark, root, "table_usage").count() == 0


def test_rerun_without_rows_leaves_none(spark, tmp_path):
    root = str(tmp_path)
    for n in (2, 0):
        history.append_snapshot(rows(spark, n), root, "table_rows", "2024-01-30 02:00:00")
    assert history.read_history(spark, root, "table_rows").count() == 0


def test_undated_and_streamed_rows_count_by_their_stamp(spark, tmp_path):
    root, landed_at = str(tmp_path / "root"), str(tmp_path / "landed")
    given = [("d", "p", n, ts(at) if at else None) for n, at in enumerate(("2024-01-29 10:00", "2024-01-30 01:00", "2024-01-30 03:00", None))]
    spark.createDataFrame(given, schema("recent_runs")).write.parquet(landed_at)
    stream = ingest.open_landed(spark, landed_at, schema("recent_runs"))
    ingest.ingest(stream, f"{root}/recent_runs", f"{root}/checkpoint").awaitTermination()
    history.append_snapshot(spark.createDataFrame([("d", "q", 9, ts("2024-01-30 01:30"))], schema("recent_runs")), root, "recent_runs", "2024-01-30 02:00:00")
    read = history.read_history(spark, root, "recent_runs", until="2024-01-30 02:00:00")
    assert tuples(read, "last_elapsed_time") == [(0,), (1,), (3,), (9,)]
    assert history.read_history(spark, root, "recent_runs").count() == 5


def test_errors_are_whole_and_of_every_run(spark, tmp_path):
    root = str(tmp_path)

    def broken():
        raise RuntimeError("x" * 1000)

    for _ in range(2):
        for tables in (("fragmentation",), ("jobs", "page_life")):
            runner.run_collect(spark, root, {t: broken for t in tables}, AT)
    found = tuples(history.read_history(spark, root, "errors"), "TableName", "Message")
    assert [t for t, _ in found] == ["fragmentation", "jobs", "page_life"] and all(m.endswith("x" * 1000) for _, m in found)


def test_point_in_time_read_prunes_partitions(spark, tmp_path):
    root = str(tmp_path)
    history.append_snapshot(rows(spark, 3), root, "table_rows", "2024-01-30 02:00:00")
    plan = history.read_history(spark, root, "table_rows", until=AT)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "snapshot_date" in plan.split("PartitionFilters: [")[1]


def test_failures_are_recorded_and_do_not_stop_others(spark, tmp_path):
    root = str(tmp_path)

    def broken():
        raise RuntimeError("source is down")

    errors = runner.run_collect(spark, root, {"fragmentation": broken, "table_rows": lambda: rows(spark, 4)}, AT)
    assert tuples(errors, "TableName", "Message") == [("fragmentation", "RuntimeError: source is down")]
    assert history.read_history(spark, root, "table_rows").count() == 4
    assert tuples(history.read_history(spark, root, "errors"), "TableName") == [("fragmentation",)]
    assert runner.run_collect(spark, root, {"table_rows": lambda: rows(spark, 4)}, AT).count() == 0


def test_expired_days_are_dropped(spark, tmp_path):
    root = str(tmp_path)
    for day in ("2023-08-03", "2023-08-04", "2024-01-30"):
        history.append_snapshot(rows(spark, 1), root, "table_rows", f"{day} 00:00:00")
    assert [str(r[0]) for r in history.expired_partitions(spark, root, "table_rows", 180, AT).collect()] == ["2023-08-03"]
    assert history.drop_expired(spark, root, "table_rows", 180, AT) == 1
    assert history.drop_expired(spark, root, "table_rows", 180, AT) == 0
    assert history.read_history(spark, root, "table_rows").count() == 2


def test_fan_in_equals_one_partitioned_read(spark, tmp_path):
    a, b = rows(spark, 2).drop("DatabaseName"), rows(spark, 3).drop("DatabaseName")
    stacked = landed.fan_in({"d1": a, "d2": b})
    path = str(tmp_path / "landed")
    stacked.write.partitionBy("DB_Name").parquet(path)
    read = landed.read_landed(spark, path, stacked.schema)
    assert tuples(read, "DB_Name", "TableName") == tuples(stacked, "DB_Name", "TableName")
    ids = spark.createDataFrame([(4,), (5,)], "database_id INT")
    assert tuples(landed.user_databases(ids)) == [(5,)]


@pytest.mark.parametrize("fmt", ["csv", "json", "orc"])
def test_landed_formats(spark, tmp_path, fmt):
    df = rows(spark, 3).select("TableName", "RowCount")
    df.write.format(fmt).save(str(tmp_path / fmt))
    assert tuples(landed.read_landed(spark, str(tmp_path / fmt), df.schema, fmt=fmt)) == tuples(df)


def test_alert_run(spark, tmp_path):
    root = str(tmp_path)
    run = {"DB_Name": "d", "SP Name": "p", "execution_count": 1, "total_elapsed_time": 1_000, "avg_elapsed_time": 1_000, "Date": ts("2024-01-01")}
    s = schema("routine_exec")
    past = spark.createDataFrame([tuple(run.get(c) for c in s.fieldNames())] * 5, s)
    history.append_snapshot(past, root, "routine_exec", "2024-01-02 00:00:00")
    runs = spark.createDataFrame([("d", "p", 5_000, ts("2024-01-30 10:00")), ("d", "p", 6_000, ts("2024-01-30 11:00"))], schema("recent_runs"))
    assert tuples(runner.run_alerts(spark, root, runs, AT), "SPName", "last_elapsed_time") == [("d.p", 5_000), ("d.p", 6_000)]
    assert tuples(runner.run_alerts(spark, root, runs.limit(1), "2024-01-31 02:00:00")) == []
    assert tuples(runner.run_alerts(spark, root, runs.limit(1), AT)) == []  # a rerun withdraws what it had stored
    assert history.read_history(spark, root, "flagged_routines").count() == 0


def test_recommendation_run(spark, tmp_path):
    root = str(tmp_path)

    def put(table, *records):
        s = schema(table)
        df = spark.createDataFrame([tuple(r.get(c) for c in s.fieldNames()) for r in records], s)
        history.append_snapshot(df, root, table, "2024-01-30 00:00:00")

    day = ts("2024-01-30")
    put("table_usage", {"DatabaseName": "d", "TableName": "t", "TotalAccesses": D(9), "TotalReads": D(9), "ReadScans": D(1), "Date": day})
    put("table_rows", {"DatabaseName": "d", "TableName": "t", "RowCount": 50, "Date": day}, {"DatabaseName": "d", "TableName": "big", "RowCount": 2_000_000, "Date": day})
    put("statistics", {"DB_Name": "d", "Table_Name": "t", "Index_Name": "i", "rowmodctr": D(10), "Date": day})
    put("index_free_space", {"DB_Name": "d", "Table_Name": "big", "Index_Name": "ib", "Free_Space_MBs": 99, "Free_Space_Percent": D(9), "Date": day})
    rebuilds, refreshes = runner.run_recommend(spark, root, AT)
    assert tuples(rebuilds, "TableName", "level") == [("big", "index"), ("t", "table")]
    assert tuples(refreshes, "Command") == [("UPDATE STATISTICS [t](i) WITH FULLSCAN",)]


def test_bounds_from_moments_equal_one_pass(spark):
    import random

    from statledger.operators import bounds

    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, 10**14 + rng.randrange(10), rng.randrange(-50, 50)]), i % 4) for i in range(300)]
    rows += [("one", 5, 0), ("nulls", None, 1), ("nulls", None, 2), ("gone", 7, 3), ("gone", 8, 3)]
    df = spark.createDataFrame(rows, "k STRING, v BIGINT, part INT")
    parts = [bounds.moments(df.filter(f"part = {i}"), ["k"], "v") for i in range(4)]
    together = bounds.merged_moments(parts, ["k"])
    for found, kept in ((together, df), (bounds.merged_moments([together], ["k"], gone=[parts[3]]), df.filter("part < 3"))):
        got = {r["k"]: r for r in bounds.bounds_of_moments(found, ["k"]).collect()}
        expected = {r["k"]: r for r in bounds.sigma_bounds(kept, ["k"], "v").collect()}
        assert set(got) == set(expected)
        for k, e in expected.items():
            assert (got[k]["Mean"], got[k]["SampleSize"]) == (e["Mean"], e["SampleSize"])
            assert got[k]["StandardDev"] == (e["StandardDev"] if e["StandardDev"] is None else pytest.approx(e["StandardDev"], rel=1e-9, abs=1e-6))


def test_alert_run_reads_sums_and_not_the_history(spark, tmp_path):
    from statledger.plans import runner
    from statledger.sources import moments

    root = str(tmp_path)
    rows = spark.createDataFrame([("db", "sp", 10 + i % 3) for i in range(30)], "DB_Name STRING, `SP Name` STRING, avg_elapsed_time BIGINT")
    for day in (1, 2, 3):
        runner.run_collect(spark, root, {"routine_exec": lambda day=day: rows.withColumn("Date", F.lit(f"2024-01-0{day} 08:00:00").cast("timestamp_ntz"))},
                           f"2024-01-0{day} 12:00:00")
    found = moments.stored_bounds(spark, root, "routine_exec", "2024-01-03 13:00:00", *runner.SUMMED["routine_exec"], days=180)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert found.first()["SampleSize"] == 90
    scans = [line for line in plan.splitlines() if "FileScan" in line and "avg_elapsed_time" in line]
    assert all("PartitionFilters" in line for line in scans)
    assert moments.stored_bounds(spark, root, "routine_exec", "2024-01-02 12:00:00", *runner.SUMMED["routine_exec"], days=180).first()["SampleSize"] == 60
    assert moments.stored_bounds(spark, root, "routine_exec", "2024-01-03 13:00:00", *runner.SUMMED["routine_exec"], days=2.2).first()["SampleSize"] == 60
