"""Reports on hand-written history tables, expected rows worked out by hand."""

from decimal import Decimal as D

import pytest
from frames import ts, tuples
from pyspark.sql import functions as F

from statledger.plans import alerts, collect, parameters, reports, worklists
from statledger.sources.schemas import conform, schema

AT = "2024-01-31 00:00:00"


def table(spark, name, *rows):
    """A history table from partial rows."""
    s = schema(name)
    return spark.createDataFrame([tuple(r.get(c) for c in s.fieldNames()) for r in rows], s)


def usage(db, name, total, date, reads=None, scans=None):
    return {"DatabaseName": db, "TableName": name, "TotalAccesses": D(total), "TotalReads": D(reads or total),
            "ReadScans": D(scans or total), "Date": ts(date)}


def size(db, name, n, date, schema_name="dbo"):
    return {"DatabaseName": db, "TableNameFull": f"[{schema_name}].[{name}]", "TableName": name, "RowCount": n, "Date": ts(date)}


def index(db, tbl, name, seeks=0, scans=0, lookups=0, updates=0, date="2024-01-29", kind="NONCLUSTERED", pk=False):
    return {"DB_Name": db, "Table_Name": tbl, "Index_Name": name, "user_seeks": D(seeks), "user_scans": D(scans),
            "user_lookups": D(lookups), "user_updates": D(updates), "type_desc": kind, "is_primary_key": pk, "Date": ts(date)}


def job(name, seconds, at="2024-01-30 10:00", step=0, status=1):
    return {"JobName": name, "JobFailStep": step, "RunDateTime": ts(at), "JobDurationSeconds": seconds,
            "RunStatus": status, "owner": "o", "source": "SQLAgent", "Date": ts(at)}


def test_weekly_jobs_count_whole_job_rows_only(spark):
    jobs = table(spark, "jobs", job("a", 10), job("a", 15), job("a", 99, step=2), job("a", None), job("a", 5, "2023-12-31 10:00"))
    got = reports.jobs_weekly(jobs)
    assert tuples(got, "JobName", "YearWeek", "TotalExecutionCount", "TotalElapsedTimeSeconds", "AvgElapsedTimeSeconds") == [
        ("a", "2023.53", 1, 5, 5), ("a", "2024.05", 3, 25, 8),
    ]


def test_scope_keeps_servers_apart(spark):
    jobs = table(spark, "jobs", job("a", 10), job("a", 20))
    fleet = jobs.withColumn("server_name", jobs["JobDurationSeconds"].cast("string"))
    got = reports.jobs_weekly(fleet, scope=["server_name"])
    assert tuples(got, "server_name", "ServerName", "TotalExecutionCount") == [("10", "10", 1), ("20", "20", 1)]
    assert reports.job_bounds(fleet, scope=["server_name"]).count() == 0
    assert reports.job_bounds(jobs).count() == 1


def test_outlying_job_runs(spark):
    calm = [job("j", 100, f"2024-01-{d:02d} 08:00") for d in range(1, 31)]
    rows = [*calm, job("j", 900, "2024-01-30 09:30"), job("j", 1, "2024-01-30 09:40"), job("once", 500)]
    got = reports.job_outliers(table(spark, "jobs", *rows), AT)
    assert tuples(got, "JobName", "JobDurationSeconds", "Hour", "SampleSize") == [("j", 900, 9, 32)]
    summary = reports.job_outlier_summary(table(spark, "jobs", *rows), AT)
    assert tuples(summary, "JobName", "Counts", "AvgJobDurationSeconds", "Hour") == [("j", 1, 900, 9)]
    assert reports.job_outliers(table(spark, "jobs", *rows), "2024-03-31").count() == 0  # older than 35 days


def test_scans_repeat_per_row_count_snapshot(spark):
    used = table(spark, "index_usage", index("d", "t", "i", scans=200), index("d", "t", "low", scans=100),
                 index("d", "t", None, scans=900), index("d", "gone", "i", scans=500))
    rows = table(spark, "table_rows", size("d", "t", 5, "2024-01-29"), size("d", "t", 6, "2024-01-25"), size("d", "t", 7, "2024-01-22"))
    assert tuples(reports.indexes_with_scans(used, rows, AT), "IndexName", "RowCount") == [("i", 5), ("i", 6)]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 100])
def test_scans_top_n_equals_the_full_join(spark, n):
    used = table(spark, "index_usage", *[index("d", f"t{i % 3}", f"i{i}", scans=200 + i // 2) for i in range(9)])
    rows = table(spark, "table_rows", *[size("d", f"t{i % 2}", i, "2024-01-29") for i in range(5)])
    got = reports.indexes_with_scans(used, rows, AT, n=n)
    pairs = sorted(
        ((-(200 + i // 2), f"t{i % 3}", f"i{i}", r) for i in range(9) for r in range(5) if i % 3 == r % 2),
    )[:n]
    assert tuples(got, "TableName", "IndexName", "RowCount") == sorted((t, i, r) for _, t, i, r in pairs)


def test_row_counts_join_and_latest(spark):
    used = table(spark, "table_usage", usage("d", "t", 10, "2024-01-30"), usage("d", "t", 9, "2024-01-26"), usage("d", "x", 1, "2024-01-30"))
    rows = table(spark, "table_rows", size("d", "t", 5, "2024-01-29"), size("d", "t", 4, "2024-01-25"))
    assert reports.tables_with_row_count(used, rows, AT).count() == 4
    assert tuples(reports.tables_with_row_count(used, rows, AT, latest=True), "RowCount", "TotalAccesses") == [(5, D(10))]


def test_stale_statistics_command(spark):
    used = table(spark, "table_usage", usage("d", "t", 200_000, "2024-01-30"))
    rows = table(spark, "table_rows", size("d", "t", 300_000, "2024-01-30"))
    stat = {"DB_Name": "d", "Table_Name": "t", "Index_Name": "i", "rowmodctr": D(150_000), "Date": ts("2024-01-30")}
    stats = table(
        spark, "statistics", {**stat, "LastUpdateDate": ts("2024-01-01")},
        {**stat, "Index_Name": "new", "LastUpdateDate": ts("2024-01-30")},
        {**stat, "Index_Name": "calm", "LastUpdateDate": ts("2024-01-01"), "rowmodctr": D(100_000)},
    )
    got = reports.stale_statistics(used, rows, stats, AT)
    assert tuples(got, "RebuildState") == [("UPDATE STATISTICS t(i) WITH FULLscan",)]


def test_fragmentation_of_top_tables(spark):
    used = table(spark, "table_usage", *[usage("d", f"t{i}", 10 + i, "2024-01-30") for i in range(4)])
    frag = table(spark, "fragmentation", *[
        {"DB_Name": "d", "Table_Name": t, "Index_Name": "i", "Avg_Fragmentation": D(f), "page_count": p, "Date": ts("2024-01-30")}
        for t, f, p in (("t3", 31, 9), ("t2", 30, 9), ("t3", 40, 8), ("t0", 90, 90))
    ])
    got = reports.fragmented_top_tables(frag, used, AT, n=2)
    assert tuples(got, "TableName", "Rebuild") == [("t3", "ALTER INDEX [i] ON [dbo].[t3] REBUILD with (ONLINE = ON)")]


def test_free_space_window_precedence(spark):
    row = {"DB_Name": "d", "Table_Name": "t", "Type": "CLUSTERED", "Total_MBs": 200}
    space = table(
        spark, "index_free_space",
        {**row, "Index_Name": "new big", "Free_Space_MBs": 51, "Free_Space_Percent": D(1), "Date": ts("2024-01-30")},
        {**row, "Index_Name": "new loose", "Free_Space_MBs": 1, "Free_Space_Percent": D(51), "Date": ts("2024-01-30")},
        {**row, "Index_Name": "old loose", "Free_Space_MBs": 1, "Free_Space_Percent": D(51), "Date": ts("2023-01-30")},
        {**row, "Index_Name": "old big", "Free_Space_MBs": 51, "Free_Space_Percent": D(1), "Date": ts("2023-01-30")},
    )
    used, rows = table(spark, "table_usage"), table(spark, "table_rows")
    names = [("new big",), ("new loose",)]
    assert tuples(reports.indexes_with_free_space(space, used, rows, AT), "IndexName") == names
    written = reports.indexes_with_free_space(space, used, rows, AT, as_written=True)
    assert tuples(written, "IndexName") == [*names, ("old loose",)]
    assert written.filter("TableRowCount IS NULL").count() == 3


def test_unneeded_indexes_average_distinct_snapshots(spark):
    used = table(
        spark, "index_usage",
        index("d", "t", "dead", updates=4, date="2024-01-10"), index("d", "t", "dead", updates=4, date="2024-01-17"),
        index("d", "t", "dead", updates=9, date="2024-01-29"),
        index("d", "t", "read", updates=9), index("d", "t", "read", seeks=1, date="2023-06-01"),
        index("d", "t", "pk", pk=True), index("d", "t", "cl", kind="CLUSTERED"), index("tempdb", "t", "tmp"),
        index("d", "t", "dropped", date="2024-01-01"), index("d", "t", None),
    )
    got = reports.unneeded_indexes(used, AT)
    assert tuples(got, "IndexName", "AvgWeekUpdates", "FirstDate", "LastDate") == [("dead", 6, ts("2024-01-10"), ts("2024-01-29"))]


def test_unchanged_tables_by_full_name(spark):
    rows = table(
        spark, "table_rows", size("d", "same", 5, "2024-01-01"), size("d", "same", 5, "2024-01-08"),
        size("d", "grew", 5, "2024-01-01"), size("d", "grew", 6, "2024-01-08"), size("d", "two", 1, "2024-01-01", "s1"),
        size("d", "two", 2, "2024-01-01", "s2"), size("tempdb", "tmp", 1, "2024-01-01"), size("d", "none", None, "2024-01-01"),
    )
    assert tuples(reports.unchanged_tables(rows)) == [("d", "same"), ("d", "two"), ("d", "two")]


def test_unused_tables_exact_and_as_written(spark):
    rows = table(spark, "table_rows", size("d", "t", 5, "2024-01-30"), size("d", "t", 6, "2024-01-26"), size("d", "idle", 9, "2024-01-30"))
    used = table(spark, "table_usage", usage("d", "t", 10, "2024-01-30"), usage("d", "t", 20, "2023-01-30"), usage("d", "t", 30, "2022-01-30"))
    assert tuples(reports.unused_tables(rows, used, AT)) == [("d", "idle", None, 9), ("d", "t", D(60), 11)]
    assert tuples(reports.unused_tables(rows, used, AT, as_written=True)) == [("d", "idle", None, 9), ("d", "t", D(120), 33)]


def test_routine_reports(spark):
    run = {"DB_Name": "d", "SP Name": "p", "execution_count": 4, "total_elapsed_time": 10_000_003, "cached_time": ts("2024-01-01"),
           "TotalLogicalReads": 9, "TotalLogicalWrites": 3, "avg_elapsed_time": 2_500_000, "Date": ts("2024-01-30")}
    runs = table(spark, "routine_exec", run, run)
    assert tuples(reports.routine_weekly(runs), "AvgExecutionDurationMilliSeconds", "ExecTimeCat", "AvgLogicalReads", "SortOrder") == [(2500, "5 Sec", 2, 2)]
    assert tuples(reports.routine_detail(runs), "AvgExecutionDurationMilliSeconds", "AvgExecutionMilliSeconds") == [(2_500_000, 2500)]
    none = table(spark, "routine_exec", {**run, "execution_count": 0})
    assert tuples(reports.routine_weekly(none), "AvgExecutionDurationMilliSeconds", "ExecTimeCat") == [(None, "> 30 Sec")]


def test_io_rates_within_a_day_and_backwards(spark):
    io = {"serID": 1, "dbID": 7, "database_drive": "C", "database_file_name": "f", "TotalIO": 7, "TotalMBs": 7}
    rows = table(
        spark, "file_io", {**io, "report_date_time_start": ts("2024-01-01 00:10"), "report_date_time_end": ts("2024-01-01 23:00")},
        {**io, "report_date_time_start": ts("2024-01-01 23:59:59"), "report_date_time_end": ts("2024-01-03 00:00:01")},
        {**io, "report_date_time_start": ts("2024-01-03"), "report_date_time_end": ts("2024-01-01")},
    )
    names = table(spark, "databases", {"dbID": 7, "serID": 1, "server_name": "s", "database_name": "d"}, {"dbID": 7, "serID": 2})
    assert tuples(reports.io_per_day(rows, names), "Days", "TotalIOperDay") == [(-2, -3), (0, 0), (2, 3)]
    assert tuples(reports.io_calendar(rows, names), "MinutesElapsed", "ServerName") == [(-2880, "s"), (1370, "s"), (1441, "s")]


def test_repeat_offenders_need_two_runs_and_exclusions_apply_after_ingest(spark):
    runs = [("d", 5, i, 2_000 if i < 3 else 1_500, ts(f"2024-01-30 {10 + i}:00")) for i in range(4)]
    stats = spark.createDataFrame(
        runs + [("d", 5, 1, 2_500, ts("2024-01-30 20:00")), ("d", 5, 2, 3_000, ts("2024-01-30 21:00")), ("d", 4, 1, 9_999, ts("2024-01-30 21:00"))],
        "DB_Name STRING, database_id INT, object_id INT, last_elapsed_time BIGINT, last_execution_time TIMESTAMP_NTZ",
    )
    procs = spark.createDataFrame([("d", 0, "p0"), ("d", 1, "p1"), ("d", 2, "p2"), ("d", 3, "p3")], "DB_Name STRING, object_id INT, name STRING")
    bounds = spark.createDataFrame(
        [("d", f"p{i}", 100, 1.0, 90.0, 1_600.0, 50) for i in range(4)],
        "DB_Name STRING, `SP Name` STRING, Mean BIGINT, StandardDev DOUBLE, LowerBound DOUBLE, UpperBound DOUBLE, SampleSize BIGINT",
    )
    excluded = spark.createDataFrame([("p2",), ("other",)], "Item STRING")
    held = table(spark, "recent_runs", {"DB_Name": "d", "SP_Name": "p0", "last_elapsed_time": 1_700, "Date": ts("2024-01-30 23:00")},
                 {"DB_Name": "d", "SP_Name": "p3", "last_elapsed_time": 9_000, "Date": ts("2024-01-30 21:59")})
    got = alerts.recent_runs(procs, stats, AT, held=held, exclusions=excluded)
    assert got.filter("SP_Name = 'p2'").count() == 0
    flagged = alerts.repeat_offenders(got, bounds)
    assert tuples(flagged) == [("p0",), ("p1",)]  # p3 has no long run left, its held one is too old
    detail = alerts.alert_detail(got, bounds, flagged, n=3)
    assert [tuple(r) for r in detail.select("SPName", "last_elapsed_time", "UpprBnd").collect()] == [
        ("d.p0", 1_700, 1_600), ("d.p0", 2_000, 1_600), ("d.p1", 2_500, 1_600),
    ]


def test_size_cut_sends_large_tables_to_index_work(spark):
    schema_t = "DBName STRING, TableName STRING, RecordCount BIGINT"
    tables = spark.createDataFrame([("d", "small", 10), ("d", "edge", 100), ("d", "large", 500), ("d", "unknown", None)], schema_t)
    indexes = spark.createDataFrame(
        [("d", t, "i", n) for t, n in (("small", 10), ("edge", 100), ("large", 500), ("unknown", None), ("huge", 9_000), ("extra", 20))],
        "DBName STRING, TableName STRING, IndexName STRING, RecordCount BIGINT",
    )
    whole, single = worklists.size_cut(tables, indexes, 100, 1_000)
    assert tuples(whole, "TableName") == [("small",)]
    assert tuples(single, "TableName") == [("extra",), ("large",)]
    commands = worklists.rebuild_commands(tables, indexes, 100, 1_000)
    assert tuples(commands, "TableName", "level") == [("extra", "index"), ("large", "index"), ("small", "table")]
    work = tables.withColumn("level", F.lit("table")).unionByName(indexes.withColumn("level", F.lit("index")), allowMissingColumns=True)
    assert tuples(worklists.commands_of(work, 100, 1_000)) == tuples(commands)
    nameless = spark.createDataFrame([("d", None, None, 5, "table"), (None, "t", "i", 5, "index")], work.select("DBName", "TableName", "IndexName", "RecordCount", "level").schema)
    assert worklists.commands_of(nameless, 100, 1_000).count() == 0
    assert worklists.commands_of(work.limit(0), 100, 1_000).count() == 0


def test_statistics_worklist(spark):
    stat = {"DB_Name": "d", "Table_Name": "t", "LastUpdateDate": ts("2024-01-01"), "Date": ts("2024-01-30")}
    stats = table(
        spark, "statistics", {**stat, "Index_Name": "share", "rowmodctr": D(30)}, {**stat, "Index_Name": "_WA_x", "rowmodctr": D(900)},
        {**stat, "Index_Name": None, "rowmodctr": D(900)}, {**stat, "Index_Name": "calm", "rowmodctr": D(20)},
        {**stat, "Index_Name": "zero", "rowmodctr": D(0)},
    )
    rows = table(spark, "table_rows", size("d", "t", 1_000, "2024-01-30"), size("d", "one", 1, "2024-01-30"))
    used = table(spark, "table_usage", usage("d", "t", 5, "2024-01-30"))
    modified = worklists.modified_percent(rows, stats, used, AT)
    assert tuples(modified, "Index_Name", "PercentModified") == [("calm", 2), ("share", 3)]
    assert tuples(worklists.stats_worklist(modified, 2, 5_000, 90_000), "Command") == [("UPDATE STATISTICS [t](share) WITH FULLSCAN",)]
    assert worklists.stats_worklist(modified, 2, 1_000, 0).count() == 0


def test_refresh_commands_are_those_of_the_modified_rows(spark):
    stat = {"DB_Name": "d", "Table_Name": "t", "Date": ts("2024-01-30")}
    stats = table(
        spark, "statistics", *[{**stat, "LastUpdateDate": ts(f"2024-01-0{i + 1}"), "Index_Name": n, "rowmodctr": D(m)} for i, (n, m) in enumerate((
            ("share", 10), ("share", 30), ("calm", 20), ("many", 25), ("_WA_x", 900), (None, 900), ("zero", 0)))],
        {**stat, "Table_Name": "unused", "LastUpdateDate": ts("2024-01-01"), "Index_Name": "i", "rowmodctr": D(900)},
        {**stat, "Table_Name": "none", "LastUpdateDate": ts("2024-01-01"), "Index_Name": "i", "rowmodctr": D(900)},
    )
    rows = table(spark, "table_rows", size("d", "t", 1_000, "2024-01-30"), size("d", "t", 900, "2024-01-29"), size("d", "t", 1, "2024-01-28"),
                 size("d", "unused", 10, "2024-01-30"))
    used = table(spark, "table_usage", usage("d", "t", 5, "2024-01-30"), usage("d", "t", 6, "2024-01-29"), usage("d", "none", 5, "2024-01-30"))
    modified = worklists.modified_percent(rows, stats, used, AT)
    for limits in ((2, 5_000, 90_000), (2, 950, 90_000), (2, 900, 0), (0, 901, 24), (100, 5_000, 24), (1, 1_001, 10)):
        got = worklists.refresh_commands(rows, stats, used, AT, *limits)
        assert tuples(got) == tuples(worklists.stats_worklist(modified, *limits))
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "REPARTITION_BY_COL" in plan and "LastUpdateDate" not in plan.split("Exchange", 1)[0]


def test_rebuild_work_is_dealt_by_table_once(spark):
    """Distinct, row counts, window and commands follow one shuffle of the candidates."""
    import re

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frames = {n: table(spark, n).limit(0) for n in ("table_usage", "table_rows", "statistics", "fragmentation", "index_free_space", "index_usage")}
        work = worklists.rebuild_work(*frames.values(), AT)
        plan = worklists.commands_of(work, 100, 1_000)._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    top = plan[: plan.index("REPARTITION_BY_COL")]
    assert len(re.findall(r"Exchange hashpartitioning", top)) == 1  # that of the candidates itself


def test_parameters(spark):
    empty = spark.createDataFrame([], schema("parameters"))
    seeded = parameters.seed_parameters(spark, empty, AT)
    assert parameters.parameter(seeded, "bp_long_run_SP", "Minutes") == "120"
    assert parameters.seed_parameters(spark, seeded, AT).count() == seeded.count()
    changes = spark.createDataFrame([("90", "bp_long_run_SP", "Minutes")], "Item STRING, SP_Name STRING, Class STRING")
    changed = parameters.change_parameters(seeded, changes, "2024-02-01 00:00:00")
    assert parameters.parameter(changed, "bp_long_run_SP", "Minutes") == "90"
    assert changed.filter("Date = TIMESTAMP_NTZ '2024-02-01 00:00:00'").count() == 1
    assert parameters.parameter(changed, "nobody", "Days", "7") == "7"
    with pytest.raises(ValueError):
        parameters.parameter(changed.unionByName(changed), "bp_long_run_SP", "Minutes")


def test_batch_and_packet_increments(spark):
    counter = spark.createDataFrame(
        [("o", "c", v, ts(f"2024-01-30 {h:02d}:00")) for h, v in ((0, 100), (2, 150), (4, 20), (6, 25))],
        "object_name STRING, counter_name STRING, cntr_value BIGINT, Date TIMESTAMP_NTZ",
    )
    got = collect.batch_delta(counter)
    assert tuples(got, "cntr_value", "seconds", "requests") == [(100, 0, 0), (150, 7200, 50), (20, 0, 150), (25, 7200, 5)]
    assert tuples(conform(got, "batch_requests").limit(0)) == []
    packets = spark.createDataFrame(
        [(10, 5, 0, ts("2024-01-30 00:00")), (30, 4, 1, ts("2024-01-30 02:00"))],
        "PacketsReceivedBase BIGINT, PacketsSentBase BIGINT, PacketErrorsBase BIGINT, Date TIMESTAMP_NTZ",
    )
    assert tuples(collect.packet_delta(packets), "seconds", "PacketsReceived", "PacketsSent", "PacketErrors") == [(0, 0, 0, 0), (7200, 20, 4, 1)]


def test_delivery_restart_and_sessions(spark):
    rows = [(1, "2024-01-30 00:00", "2024-01-30 10:00", 10), (1, "2024-01-30 00:00", "2024-01-30 10:30", 70),
            (1, "2024-01-30 10:40", "2024-01-30 11:00", 5), (1, "2024-01-30 10:40", "2024-01-30 11:10", 3),
            (1, "2024-01-30 10:40", "2024-01-30 11:20", 9), (1, "2024-01-30 10:40", "2024-01-30 11:30", 0)]
    history = spark.createDataFrame(
        [(a, ts(s), 3, ts(t), n) for a, s, t, n in rows], "agent_id INT, start_time TIMESTAMP_NTZ, runstatus INT, time TIMESTAMP_NTZ, delivered_commands INT"
    )
    agents = spark.createDataFrame([(1, "agent")], "id INT, name STRING")
    got = collect.delivery_rate(history, agents)
    assert tuples(got, "delivered_commands", "seconds", "commands", "commands_per_Minute") == [(10, 0, 0, 0), (3, 600, 0, 0), (5, 0, 0, 0), (70, 1800, 60, 2)]
    assert collect.delivery_rate(history, agents, keep_newest=True).count() == 5


def test_cpu_samples_with_a_missing_node(spark):
    def record(i, idle):
        node = f"<SystemIdle>{idle}</SystemIdle>" if idle is not None else ""
        return (f'<Record id="{i}"><SchedulerMonitorEvent><SystemHealth>{node}<ProcessUtilization>30</ProcessUtilization>'
                "</SystemHealth></SchedulerMonitorEvent></Record>")

    ring = spark.createDataFrame(
        [(1_000_000, record(1, 60)), (940_000, record(2, None)), (1_000_000 - 8_000_000, record(3, 1)), (1_000_000, "<Record/>")],
        "timestamp BIGINT, record STRING",
    )
    got = collect.cpu_samples(ring, 1_000_000, AT)
    assert tuples(got, "Date", "SQLProcessUtilization", "SystemIdle", "OtherProcessUtilization") == [
        (ts("2024-01-30 23:59:00"), 30, None, None), (ts(AT), 30, 60, 10),
    ]


def test_agent_jobs_long_durations_and_window(spark):
    jobs = spark.createDataFrame([(1, "n" * 80), (2, "idle")], "job_id INT, name STRING")
    runs = spark.createDataFrame(
        [(1, 20240130, 215959, 5959, "Failed. Because of it", 0, 1), (1, 20240126, 200000, 1000000, "x", 0, 1),
         (1, 20240130, 100000, 10, "x", 0, 1), (1, 20249999, 1, 1, "bad", 0, 1)],
        "job_id INT, run_date INT, run_time INT, run_duration INT, message STRING, step_id INT, run_status INT",
    )
    got = collect.agent_jobs(jobs, runs, AT)
    assert tuples(got, "RunDateTime", "JobDurationSeconds", "JobFailMessage") == [
        (ts("2024-01-26 20:00:00"), 360_000, ""), (ts("2024-01-30 21:59:59"), 3_599, "Because of it"),
    ]
    assert {len(r["JobName"]) for r in got.collect()} == {60}


def test_register_databases_once_per_database(spark):
    servers = table(spark, "servers", {"serID": 1, "server_name": "s"})
    known = table(spark, "databases", {"dbID": 5, "serID": 1, "server_name": "s", "database_name": "old"})
    snap = spark.createDataFrame([("s", "old"), ("s", "new"), ("s", "new"), ("s", None)], "server_name STRING, databasename STRING")
    got = collect.register_databases(known, servers, snap)
    assert tuples(got, "serID", "database_name") == [(1, "new"), (1, "old")]
    assert tuples(collect.register_databases(got, servers, snap)) == tuples(got)


def test_memory_bytes_source_and_signals(spark):
    counters = spark.createDataFrame(
        [("x", "physical_memory_in_bytes", "", 81_920), ("SQLServer:Memory Manager  ", "Memory Grants Pending  ", "", 3),
         ("x", "Cursor memory usage", "_Total", 8), ("x", "Cursor memory usage", "other", 99), ("x", "process_physical_memory_low", "", 1)],
        "object_name STRING, counter_name STRING, instance_name STRING, cntr_value BIGINT",
    )
    row = collect.memory_snapshot(counters, AT, bytes_source=True).first()
    assert (row["Total_Physical_Memory_KB"], row["Memory_Grants_Pending"], row["Mem_Used_KB_Cursors"]) == (10, 3, 8)
    assert row["Process_Physical_Memory_Low"] is True and row["System_Low_Memory_Signal_State"] is False
    assert conform(collect.memory_snapshot(counters, AT), "memory").columns == schema("memory").fieldNames()


def test_buffer_space_counts_unknown_pages_as_clean(spark):
    pages = spark.createDataFrame(
        [(1, True, 1024)] * 2 + [(1, None, 2048)] + [(2, False, 1)], "allocation_unit_id INT, is_modified BOOLEAN, free_space_in_bytes INT"
    )
    got = collect.buffer_space(pages, ["allocation_unit_id"], min_pages=2)
    assert tuples(got, "DPCount", "CPCount", "DPFreeSpace", "CPFreeSpace", "Free_Space_Percent") == [(2, 1, 2048, 2048, D("16.7"))]


def test_clean_statistics_on_listed_servers(spark):
    stats = table(spark, "statistics", {"DB_Name": "d", "rowmodctr": D(0)}, {"DB_Name": "d", "rowmodctr": None},
                  {"DB_Name": "tempdb", "rowmodctr": D(1)}, {"DB_Name": None, "rowmodctr": D(1)})
    assert collect.clean_statistics(stats).count() == 3
    assert collect.clean_statistics(stats, quiet_servers=["big"], server="big").count() == 2
    assert collect.clean_statistics(stats, quiet_servers=["big"], server="small").count() == 3
