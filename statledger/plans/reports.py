"""The reports over the history tables, one function per report.

Inputs are history tables (see ``sources.schemas``), ``as_of`` replaces "now".
``scope`` lists leading key columns, such as ``server_name``, that every input
carries when one table holds a whole fleet; they join all grouping and join keys
and come first in the output.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import guarded_div, int_avg, int_div, micros_to_millis, ratio_of_sums, trunc_int
from ..functions.text import clean_text, rebuild_index_command, update_statistics_command
from ..functions.timeparts import boundary_diff, date_key, midnight, days_before, ts_lit, week_label, week_slot, weekday_name, year_week
from ..operators.bounds import outlier_summary, outliers, sigma_bounds
from ..operators.ordered import HOT_ROWS, latest_per, top_k, top_k_per
from ..operators.rollup import duration_bucket, single_valued
from ..operators.timewindow import recent, until

Scope = Sequence[str]

WEEK = 6.9  # days: a weekly snapshot is seen exactly once
STEP_OUTCOME = 0  # step number of the row that records the outcome of the whole job
JOB_KEYS = ["JobName", "JobFailStep", "RunStatus", "source"]
ROUTINE_KEYS = ["DB_Name", "SP Name"]


# ---------------------------------------------------------------- jobs

def jobs_weekly(jobs: DataFrame, *, scope: Scope = ()) -> DataFrame:
    """Runs, total and mean seconds per job, status, owner and week (whole-job rows only)."""
    server = F.col(scope[0]) if scope else F.lit(None).cast("string")
    grouped = (
        jobs.filter(F.col("JobFailStep") == STEP_OUTCOME)
        .groupBy(*scope, "JobName", "RunStatus", week_slot("RunDateTime").alias("__week"), "owner")
        .agg(
            F.count("JobName").alias("TotalExecutionCount"),
            F.sum("JobDurationSeconds").alias("TotalElapsedTimeSeconds"),
        )
    )
    return grouped.select(
        *scope, "JobName", "RunStatus", week_label("__week").alias("YearWeek"), "TotalExecutionCount",
        "TotalElapsedTimeSeconds",
        int_div("TotalElapsedTimeSeconds", "TotalExecutionCount").alias("AvgElapsedTimeSeconds"), "owner",
        server.alias("ServerName"),
    )


def jobs_detail(jobs: DataFrame, *, scope: Scope = ()) -> DataFrame:
    """Whole-job runs with their week."""
    return jobs.filter(F.col("JobFailStep") == STEP_OUTCOME).select(
        *scope, "JobName", "RunDateTime", year_week("RunDateTime").alias("YearWeek"), "JobDurationSeconds",
        "RunStatus", "owner", "source", "Date",
    )


def job_bounds(jobs: DataFrame, *, scope: Scope = ()) -> DataFrame:
    """Three-sigma bounds of run time per job, step, status and source."""
    return sigma_bounds(jobs, [*scope, *JOB_KEYS], "JobDurationSeconds")


def job_outliers(jobs: DataFrame, as_of, *, days=35, scope: Scope = (), hot_rows: int = HOT_ROWS) -> DataFrame:
    """Runs of the last ``days`` longer than 3 seconds and outside the bounds of all history."""
    keys = [*scope, *JOB_KEYS]
    tested = recent(jobs.filter(F.col("JobDurationSeconds") > 3), "RunDateTime", days, as_of)
    found = outliers(
        tested.select(*keys, "JobDurationSeconds", "RunDateTime"),
        job_bounds(until(jobs, "RunDateTime", as_of), scope=scope), keys, "JobDurationSeconds", hot_rows=hot_rows,
    )
    return found.select(
        *scope, "JobName", "JobFailStep", "JobDurationSeconds", "RunDateTime", "Mean", "StandardDev", "LowerBound",
        "UpperBound", "RunStatus", "SampleSize", F.to_date("RunDateTime").alias("DateOnly"),
        F.hour("RunDateTime").alias("Hour"), "source",
    )


def job_outlier_summary(jobs: DataFrame, as_of, *, days=35, scope: Scope = (), hot_rows: int = HOT_ROWS) -> DataFrame:
    """Outlying runs counted per job and hour of day."""
    found = job_outliers(jobs, as_of, days=days, scope=scope, hot_rows=hot_rows)
    return outlier_summary(
        found, [*scope, *JOB_KEYS], "JobDurationSeconds", "DateOnly", "AvgJobDurationSeconds", by=["Hour"]
    )


# ---------------------------------------------------------------- routines

def routine_weekly(runs: DataFrame, *, scope: Scope = ()) -> DataFrame:
    """Executions, mean duration and its bucket, mean reads and writes per routine, plan and week."""
    mean = ratio_of_sums("total_elapsed_time", "execution_count")
    label, order = duration_bucket(F.col("__mean"))
    grouped = runs.groupBy(
        *scope, F.col("DB_Name").alias("DBName"), F.col("SP Name").alias("SPName"), "cached_time",
        week_slot("Date").alias("__week"),
    ).agg(
        F.sum("execution_count").alias("TotalExecutionCount"),
        F.sum("total_elapsed_time").alias("TotalElapsedTime"),
        mean.alias("__mean"),
        ratio_of_sums("TotalLogicalReads", "execution_count").alias("AvgLogicalReads"),
        ratio_of_sums("TotalLogicalWrites", "execution_count").alias("AvgTotalLogicalWrites"),
    )
    return grouped.select(
        *scope, "DBName", "SPName", "cached_time", "TotalExecutionCount", "TotalElapsedTime",
        micros_to_millis("__mean").alias("AvgExecutionDurationMilliSeconds"), label.alias("ExecTimeCat"),
        "AvgLogicalReads", "AvgTotalLogicalWrites", week_label("__week").alias("YearWeek"), order.alias("SortOrder"),
    )


def routine_detail(runs: DataFrame, *, scope: Scope = ()) -> DataFrame:
    """Distinct snapshots of each routine with duration bucket and week.

    ``AvgExecutionDurationMilliSeconds`` keeps its historical name but holds
    microseconds; ``AvgExecutionMilliSeconds`` has the unit its name says.
    """
    mean = int_div("TotalElapsedTime", "TotalExecutionCount")
    label, order = duration_bucket(mean)
    # everything else is derived from these columns, so only they take part in the distinct
    snapshots = runs.select(
        *scope, F.col("DB_Name").alias("DBName"), F.col("SP Name").alias("SPName"), "Date",
        F.col("execution_count").alias("TotalExecutionCount"), F.col("total_elapsed_time").alias("TotalElapsedTime"),
        "TotalLogicalReads", "TotalLogicalWrites",
    ).distinct()
    return snapshots.select(
        *scope, "DBName", "SPName", "Date", "TotalExecutionCount", "TotalElapsedTime", label.alias("ExecTimeCat"),
        "TotalLogicalReads", "TotalLogicalWrites", year_week("Date").alias("YearWeek"),
        mean.alias("AvgExecutionDurationMilliSeconds"), micros_to_millis(mean).alias("AvgExecutionMilliSeconds"),
        order.alias("SortOrder"),
    )


def routine_bounds(runs: DataFrame, *, scope: Scope = ()) -> DataFrame:
    """Three-sigma bounds of mean elapsed time per database and routine."""
    return sigma_bounds(runs, [*scope, *ROUTINE_KEYS], "avg_elapsed_time")


def routine_outliers(runs: DataFrame, as_of, *, days=35, scope: Scope = (), hot_rows: int = HOT_ROWS) -> DataFrame:
    """Snapshots of the last ``days`` over 3 microseconds and outside the bounds of all history."""
    keys = [*scope, *ROUTINE_KEYS]
    tested = recent(runs.filter(F.col("avg_elapsed_time") > 3), "Date", days, as_of)
    found = outliers(
        tested.select(*keys, "avg_elapsed_time", "Date"), routine_bounds(until(runs, "Date", as_of), scope=scope), keys,
        "avg_elapsed_time", hot_rows=hot_rows,
    )
    return found.select(
        *keys, "avg_elapsed_time", "Date", "Mean", "StandardDev", "LowerBound", "UpperBound", "SampleSize",
        F.to_date("Date").alias("DateOnly"),
    )


def routine_outlier_summary(
    runs: DataFrame, as_of, *, days=35, scope: Scope = (), hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Outlying snapshots counted per routine."""
    found = routine_outliers(runs, as_of, days=days, scope=scope, hot_rows=hot_rows)
    return outlier_summary(found, [*scope, *ROUTINE_KEYS], "avg_elapsed_time", "DateOnly", "AvgElapsedTime")


def routine_scripts(modules: DataFrame, objects: DataFrame, *, scope: Scope = ()) -> DataFrame:
    """Routine text as stored and with line breaks and tabs removed, for word analysis.

    Replication routines, known by their prefix, are left out.
    """
    # Object type code and name prefixes.
    procedures = objects.filter(
        (F.col("type") == "P") & ~F.substring("name", 1, 8).isin("sp_MSupd", "sp_MSins", "sp_MSdel")
    )
    joined = modules.join(procedures, [*scope, "object_id"])
    return joined.select(
        *scope, F.col("name").alias("ProcName"), F.trim("definition").alias("CreateScript"),
        clean_text("definition").alias("R_CreateScript"), "create_date", "modify_date",
    )


# ---------------------------------------------------------------- volumes and file I/O

def batch_volumes(counters: DataFrame, *, scope: Scope = ()) -> DataFrame:
    """Requests per second by counter and calendar slot (weekday, hour, month, day and week).

    The counter name is a grouping key but not an output column.
    """
    grouped = (
        counters.filter(F.col("seconds") > 0)
        .groupBy(*scope, "counter_name", F.to_date("Date").alias("__day"), F.hour("Date").alias("Hour"))
        .agg(
            ratio_of_sums("requests", "seconds").alias("RequestsPerSecond"),
            F.count("Date").alias("MeasureCount"),
        )
    )
    # weekday, month, day key and week all follow from the day
    return grouped.select(
        *scope, F.dayofweek("__day").alias("DayOfWeekday"), weekday_name("__day").alias("Weekday"), "Hour",
        F.month("__day").alias("Month"), "RequestsPerSecond", "MeasureCount", date_key("__day").alias("DateKey"),
        year_week("__day").alias("YearWeek"),
    )


def file_io_named(file_io: DataFrame, databases: DataFrame) -> DataFrame:
    """File I/O rows with the names of their server and database."""
    names = databases.select("dbID", "serID", "server_name", "database_name")
    return file_io.join(names, ["dbID", "serID"])


def io_calendar(file_io: DataFrame, databases: DataFrame) -> DataFrame:
    """File I/O per interval with day key, hour, week and interval length in minutes."""
    end = F.col("report_date_time_end")
    return file_io_named(file_io, databases).select(
        F.col("server_name").alias("ServerName"), F.col("database_name").alias("DatabaseName"),
        F.col("database_drive").alias("DatabaseDrive"), F.col("database_file_name").alias("FileName"),
        "TotalIO", "TotalMBs", "IoStallMS", "AvgStallPerIO", end.alias("report_date_time_end"),
        date_key(end).alias("DateKey"), F.hour(end).alias("Hour"),
        boundary_diff("minute", "report_date_time_start", end).alias("MinutesElapsed"), year_week(end).alias("YearWeek"),
    )


def io_per_day(file_io: DataFrame, databases: DataFrame) -> DataFrame:
    """File I/O per interval with daily rates; an interval within one day has rate 0."""
    days = boundary_diff("day", "report_date_time_start", "report_date_time_end")
    return file_io_named(file_io, databases).select(
        "server_name", "database_name", "database_drive", "database_file_name", "NumberReads", "NumberWrites",
        "TotalIO", guarded_div(F.col("TotalIO"), days).alias("TotalIOperDay"), "MBsRead", "MBsWritten", "TotalMBs",
        guarded_div(F.col("TotalMBs"), days).alias("TotalMBsperDay"), "IoStallReadMS", "IoStallWriteMS", "IoStallMS",
        "AvgStallPerReadIO", "AvgStallPerWriteIO", "AvgStallPerIO", "report_date_time_start", "report_date_time_end",
        midnight("report_date_time_end").alias("End_Date"), days.alias("Days"),
    )


# ---------------------------------------------------------------- tables, indexes, statistics

def _by_table(df: DataFrame, database: str, table: str) -> DataFrame:
    return df.withColumnsRenamed({database: "DBName", table: "TableName"})


def indexes_with_scans(
    index_usage: DataFrame, table_rows: DataFrame, as_of, *, days=8, min_scans=100, n=1000, scope: Scope = ()
) -> DataFrame:
    """The ``n`` most scanned indexes with their table's row count.

    Snapshot dates are not matched, so two row-count snapshots in the window give
    two rows per index. Only index rows that have a partner can appear and each
    gives at least one row, so ``n`` of them, with ``n`` partners each, decide the
    result; the full set of pairs is never built.
    """
    keys = [*scope, "DBName", "TableName"]
    wanted = recent(index_usage, "Date", days, as_of).filter(
        (F.col("user_scans") > min_scans) & F.col("Index_Name").isNotNull()
    )
    usage = _by_table(wanted, "DB_Name", "Table_Name").select(
        *keys, F.col("Index_Name").alias("IndexName"), "user_seeks", "user_scans", "user_lookups", "user_updates",
        "type_desc", "fill_factor", "is_primary_key", "Date",
    )
    sizes = _by_table(recent(table_rows, "Date", days, as_of), "DatabaseName", "TableName").select(*keys, "RowCount")
    order = [F.desc("user_scans"), *keys, "IndexName", "Date", "user_seeks", "user_lookups", "user_updates",
             "type_desc", "fill_factor", "is_primary_key"]
    leading = top_k(usage.join(sizes.select(*keys).distinct(), keys, "left_semi"), n, order)
    partners = top_k_per(
        sizes.join(F.broadcast(leading.select(*keys).distinct()), keys, "left_semi"), keys, n, [F.col("RowCount")]
    )
    joined = partners.join(F.broadcast(leading), keys)
    return top_k(joined, n, [*order, "RowCount"]).select(
        *keys, "IndexName", "RowCount", "user_seeks", "user_scans", "user_lookups", "user_updates", "type_desc",
        "fill_factor", "is_primary_key", "Date",
    )


def tables_with_row_count(
    table_usage: DataFrame, table_rows: DataFrame, as_of, *, days=WEEK, latest: bool = False, scope: Scope = ()
) -> DataFrame:
    """Recent table usage with recent row counts, for tables that have both.

    Several snapshots in the window multiply; ``latest`` first keeps the newest
    snapshot of each table on both sides.
    """
    keys = [*scope, "DBName", "TableName"]
    usage = _by_table(recent(table_usage, "Date", days, as_of), "DatabaseName", "TableName").select(
        *keys, "TotalAccesses", "TotalReads", "ReadScans", "Date"
    )
    sizes = _by_table(recent(table_rows, "Date", days, as_of), "DatabaseName", "TableName").select(
        *keys, "RowCount", F.col("Date").alias("__rows_date")
    )
    if latest:
        usage, sizes = latest_per(usage, keys, "Date"), latest_per(sizes, keys, "__rows_date")
    return usage.join(sizes.drop("__rows_date"), keys).select(
        *keys, "RowCount", "TotalAccesses", "TotalReads", "ReadScans", "Date"
    )


def tables_with_statistics(
    table_usage: DataFrame, table_rows: DataFrame, statistics: DataFrame, as_of, *, days=WEEK, latest: bool = False,
    scope: Scope = (),
) -> DataFrame:
    """Recent table usage, row counts and statistics, for tables that have all three."""
    used = tables_with_row_count(table_usage, table_rows, as_of, days=days, latest=latest, scope=scope)
    return with_statistics(used, statistics, as_of, days=days, latest=latest, scope=scope)


def with_statistics(
    sized: DataFrame, statistics: DataFrame, as_of, *, days=WEEK, latest: bool = False, scope: Scope = ()
) -> DataFrame:
    """Rows of :func:`tables_with_row_count` with the recent statistics of their tables."""
    keys = [*scope, "DBName", "TableName"]
    stats = _by_table(recent(statistics, "Date", days, as_of), "DB_Name", "Table_Name").select(
        *keys, F.col("Index_Name").alias("IndexName"), "LastUpdateDate", "rowmodctr", F.col("Date").alias("__stats_date")
    )
    if latest:
        stats = latest_per(stats, [*keys, "IndexName"], "__stats_date")
    return sized.join(stats.drop("__stats_date"), keys).select(
        *keys, "RowCount", "IndexName", "LastUpdateDate", "rowmodctr", "TotalAccesses", "TotalReads", "ReadScans", "Date"
    )


def stale_statistics(
    table_usage: DataFrame, table_rows: DataFrame, statistics: DataFrame, as_of, *, threshold=100_000, age_days=7,
    n=1000, latest: bool = False, scope: Scope = (),
) -> DataFrame:
    """The ``n`` smallest large, busy tables with old and heavily modified statistics, with the command to run."""
    joined = tables_with_statistics(table_usage, table_rows, statistics, as_of, latest=latest, scope=scope)
    return stale_of(joined, as_of, threshold=threshold, age_days=age_days, n=n, scope=scope)


def stale_of(
    joined: DataFrame, as_of, *, threshold=100_000, age_days=7, n=1000, scope: Scope = ()
) -> DataFrame:
    """:func:`stale_statistics` from rows of :func:`with_statistics`."""
    candidates = joined.filter(
        F.col("IndexName").isNotNull()
        & (F.col("RowCount") > threshold)
        & (F.col("TotalAccesses") > threshold)
        & (F.col("rowmodctr") > threshold)
        & (F.col("LastUpdateDate") < ts_lit(days_before(as_of, age_days)))
    )
    order = [F.asc("RowCount"), *scope, "DBName", "TableName", "IndexName", "LastUpdateDate", "rowmodctr",
             "TotalAccesses", "TotalReads", "ReadScans", "Date"]
    return top_k(candidates, n, order).withColumn("RebuildState", update_statistics_command("TableName", "IndexName"))


def fragmented_top_tables(
    fragmentation: DataFrame, table_usage: DataFrame, as_of, *, days=WEEK, n=100, min_fragmentation=30, min_pages=8,
    scope: Scope = (),
) -> DataFrame:
    """Fragmented indexes of the ``n`` most used tables, with the rebuild command.

    "Most used" is by total accesses, then name. The top list has ``n`` rows, so it is broadcast.
    """
    keys = [*scope, "DBName", "TableName"]
    usage = _by_table(recent(table_usage, "Date", days, as_of), "DatabaseName", "TableName").select(
        *keys, "TotalAccesses", "TotalReads", "ReadScans", F.col("Date").alias("__usage_date")
    )
    top = top_k(usage, n, [F.desc("TotalAccesses"), *keys, "__usage_date", "TotalReads", "ReadScans"])
    broken = _by_table(recent(fragmentation, "Date", days, as_of), "DB_Name", "Table_Name").filter(
        (F.col("Avg_Fragmentation") > min_fragmentation) & (F.col("page_count") > min_pages)
    )
    return broken.join(F.broadcast(top), keys).select(
        *keys, F.col("Index_Name").alias("IndexName"), "Avg_Fragmentation", "Date", "page_count", "TotalAccesses",
        "TotalReads", "ReadScans", rebuild_index_command("TableName", "Index_Name").alias("Rebuild"),
    )


def spacious_indexes(
    free_space: DataFrame, as_of, *, days=WEEK, min_mb=50, min_percent=50, as_written: bool = False
) -> DataFrame:
    """The rows of :func:`indexes_with_free_space` as they were stored, without size and use of their table."""
    big, loose = F.col("Free_Space_MBs") > min_mb, F.col("Free_Space_Percent") > min_percent
    if as_written:
        in_window = (F.col("Date") > ts_lit(days_before(as_of, days))) & (F.col("Date") <= ts_lit(as_of))
        spacious = free_space.filter((in_window & big) | loose)
    else:
        spacious = recent(free_space, "Date", days, as_of).filter(big | loose)
    return _by_table(spacious, "DB_Name", "Table_Name")


def indexes_with_free_space(
    free_space: DataFrame, table_usage: DataFrame, table_rows: DataFrame, as_of, *, days=WEEK, min_mb=50, min_percent=50,
    as_written: bool = False, latest: bool = False, scope: Scope = (),
) -> DataFrame:
    """Indexes with much free space, with size and use of their table, and the rebuild command.

    By default both size conditions are limited to the window. ``as_written``
    binds the window to the first condition only, so old rows with a high free
    percentage appear as well.
    """
    keys = [*scope, "DBName", "TableName"]
    spacious = spacious_indexes(free_space, as_of, days=days, min_mb=min_mb, min_percent=min_percent, as_written=as_written)
    used = tables_with_row_count(table_usage, table_rows, as_of, days=days, latest=latest, scope=scope).select(
        *keys, F.col("RowCount").alias("TableRowCount"), "TotalAccesses"
    )
    return spacious.join(used, keys, "left").select(
        *keys, F.col("Index_ID").alias("IndexID"), F.col("Index_Name").alias("IndexName"), "Type", "Total_MBs",
        "Free_Space_MBs", "Free_Space_Percent", "TableRowCount", "TotalAccesses", "Date",
        rebuild_index_command("TableName", "Index_Name").alias("Rebuild"),
    )


def unneeded_indexes(index_usage: DataFrame, as_of, *, days=WEEK, scope: Scope = ()) -> DataFrame:
    """Named non-clustered secondary indexes that were never read and still exist.

    Equal counter snapshots are collapsed first, so the mean of the updates is
    over distinct snapshots, not over weeks.
    """
    counters = ["user_seeks", "user_scans", "user_lookups", "user_updates"]
    keys = [*scope, "DB_Name", "Table_Name", "Index_Name"]
    # Stored counters have at most 18 digits: as bigint they are summed without decimal objects.
    whole = {c: F.col(c).cast("bigint") for c in counters}
    snapshots = (
        until(index_usage, "Date", as_of).filter(
            F.col("Index_Name").isNotNull()
            & ~F.col("is_primary_key")
            & (F.col("type_desc") == "NONCLUSTERED")
            & (F.col("DB_Name") != "tempdb")
        )
        .withColumns(whole)
        .groupBy(*keys, *counters)
        .agg(F.min("Date").alias("FirstDate"), F.max("Date").alias("LastDate"))
    )
    grouped = snapshots.groupBy(*keys).agg(
        F.sum("user_seeks").cast("decimal(38,0)").alias("TotalSeeks"),
        F.sum("user_scans").cast("decimal(38,0)").alias("TotalScans"),
        F.sum("user_lookups").cast("decimal(38,0)").alias("TotalLookups"),
        trunc_int(int_avg("user_updates")).alias("AvgWeekUpdates"),
        F.min("FirstDate").alias("FirstDate"),
        F.max("LastDate").alias("LastDate"),
    )
    unread = (F.col("TotalScans") == 0) & (F.col("TotalSeeks") == 0) & (F.col("TotalLookups") == 0)
    return (
        recent(grouped.filter(unread), "LastDate", days, as_of)
        .withColumnsRenamed({"DB_Name": "DBName", "Table_Name": "TableName", "Index_Name": "IndexName"})
    )


def table_row_counts(table_rows: DataFrame, as_of, *, days=WEEK, scope: Scope = ()) -> DataFrame:
    """Recent row counts outside the temporary database."""
    return recent(table_rows, "Date", days, as_of).filter(F.col("DatabaseName") != "tempdb").select(
        *scope, "DatabaseName", "TableNameFull", "TableName", "RowCount", "Date"
    )


def table_row_trend(table_rows: DataFrame, *, scope: Scope = ()) -> DataFrame:
    """All row counts outside the temporary database."""
    return table_rows.filter(F.col("DatabaseName") != "tempdb").select(
        *scope, "DatabaseName", "TableName", "RowCount", "Date"
    )


def unchanged_tables(table_rows: DataFrame, *, scope: Scope = ()) -> DataFrame:
    """Tables whose row count never changed. Told apart by full name, which is not an output column."""
    keys = [*scope, "DatabaseName", "TableNameFull", "TableName"]
    fixed = single_valued(table_rows.filter(F.col("DatabaseName") != "tempdb"), keys, "RowCount")
    return fixed.drop("TableNameFull")


def unused_tables(
    table_rows: DataFrame, table_usage: DataFrame, as_of, *, days=WEEK, as_written: bool = False, scope: Scope = ()
) -> DataFrame:
    """Recent tables with their summed accesses and rows; NULL accesses mean the table was never read.

    By default each side is summed on its own. ``as_written`` gives the sums over
    all snapshot pairs (every usage snapshot counted once per row-count snapshot
    and the other way round), computed from counts without building the pairs.
    """
    keys = [*scope, "DatabaseName", "TableName"]
    rows = table_row_counts(table_rows, as_of, days=days, scope=scope).groupBy(*keys).agg(
        F.sum("RowCount").alias("__rows"), F.count(F.lit(1)).alias("__n_rows")
    )
    usage = until(table_usage, "Date", as_of).groupBy(*keys).agg(
        F.sum("TotalAccesses").alias("__accesses"), F.count(F.lit(1)).alias("__n_usage")
    )
    joined = rows.join(usage, keys, "left")
    if as_written:
        accesses: Column = F.col("__accesses") * F.col("__n_rows")
        row_count: Column = F.col("__rows") * F.coalesce(F.col("__n_usage"), F.lit(1))
    else:
        accesses, row_count = F.col("__accesses"), F.col("__rows")
    return joined.select(*keys, accesses.alias("TotalAccesses"), row_count.alias("RowCount"))
