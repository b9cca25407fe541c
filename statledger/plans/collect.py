"""Snapshot collectors: landed raw extracts in, rows of the history tables out.

Each landed extract of a database-level view carries the column ``DB_Name`` (see
``sources.landed``), so one job covers every database. Object names come from the
landed ``objects`` dimension. ``scope`` works as in the reports.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import (
    bytes_to_mb, guarded_div, int_div, micros_to_millis, micros_to_seconds, millis_to_seconds, pages_to_kb,
    pages_to_mb,
)
from ..functions.text import message_tail, quotename, statement_slice
from ..functions.timeparts import (
    add_seconds, boundary_diff, date_key, days_before, packed_datetime, packed_seconds, tick_time, ts_lit,
)
from ..operators.counters import counter_delta, counter_ratio, counter_step, per_minute, pivot_counters
from ..operators.joins import span_join, update_from
from ..operators.ordered import HOT_ROWS, top_k, top_k_per, with_previous
from ..operators.rollup import USAGE_TOTALS, usage_totals, with_shares
from ..operators.timewindow import PARTITION, drop_where, recent

Scope = Sequence[str]

TWO_HOURS = 2 / 24

# Object type codes of procedures and functions.
ROUTINE_TYPES = ["P", "X", "AF", "FN", "FS", "FT", "IF", "PC", "TF"]
FIRST_USER_DATABASE = 5
FIRST_USER_OBJECT = 101
MIN_PAGES = 12_800  # 100 MB of buffer pages


def stamped(df: DataFrame, as_of, column: str = "Date") -> DataFrame:
    """Add the load time."""
    return df.withColumn(column, ts_lit(as_of))


def _named(df: DataFrame, objects: DataFrame, scope: Scope, name: str = "Table_Name") -> DataFrame:
    """Attach the object name; an unknown id gives NULL."""
    keys = [*scope, "DB_Name", "object_id"]
    names = objects.select(*keys, F.col("name").alias(name))
    return df.join(_catalogue(names), keys, "left")


def _catalogue(df: DataFrame) -> DataFrame:
    """A catalogue as the side of a join. It grows with the fleet, and Spark's estimate from compressed files is far below its size in
    memory: broadcast, every task would hold all of it. In a sort-merge join a task holds its own keys, and what is beyond its memory spills."""
    return df.hint("merge")


def _indexed(df: DataFrame, indexes: DataFrame, objects: DataFrame, scope: Scope, *columns) -> DataFrame:
    """Attach ``columns`` of the index and the name of its object, for rows that have an index. The two catalogues meet first, so the rows are shuffled once."""
    keys = [*scope, "DB_Name", "object_id", "index_id"]
    return df.join(_catalogue(_named(indexes.select(*keys, *columns), objects, scope)), keys)


# ---------------------------------------------------------------- weekly: tables, indexes, routines

def server_dim(servers: DataFrame, probes: DataFrame, *, probed_at: str | None = None) -> DataFrame:
    """Refresh version, edition, processors and memory of the servers that were probed.

    Of several probes of a server the newest by the column ``probed_at`` counts; without one, the greatest values.

    The two processor columns keep the assignment existing readers rely on:
    ``sql_physical_cpus`` is the processor count, ``sql_logical_cpus`` the count
    divided by the hyper-thread ratio.
    """
    banner = F.col("version_banner")
    after_on = F.instr(F.lower(banner), " on ") + F.lit(14)
    fresh = probes.select(
        "server_name",
        F.col("product_version").alias("sql_version_num"),
        F.col("edition").alias("sql_edition"),
        F.col("cpu_count").cast("int").alias("sql_physical_cpus"),
        int_div("cpu_count", "hyperthread_ratio").cast("int").alias("sql_logical_cpus"),
        int_div("total_physical_memory_kb", 1024).cast("int").alias("AvailableRAM"),
        int_div("total_server_memory_kb", 1024).cast("int").alias("MaxSQLRAM"),
        F.substring(banner, after_on, F.lit(4)).alias("windows_version_num"),
        *([F.col(probed_at).alias("__at")] if probed_at else []),
    )
    values = [c for c in fresh.columns[1:] if c != "__at"]
    return update_from(servers, fresh, ["server_name"], values, newest_by="__at" if probed_at else None)


def fragmentation(physical: DataFrame, indexes: DataFrame, objects: DataFrame, as_of, *, scope: Scope = ()) -> DataFrame:
    """Index fragmentation per partition."""
    return stamped(_indexed(physical, indexes, objects, scope, "name"), as_of).select(
        *scope, "DB_Name", "Table_Name", F.col("index_id").alias("Index_ID"), F.col("name").alias("Index_Name"),
        F.col("avg_fragmentation_in_percent").cast("decimal(4,1)").alias("Avg_Fragmentation"), "Date", "page_count",
        "partition_number",
    )


def statistics(stats: DataFrame, objects: DataFrame, as_of, *, scope: Scope = ()) -> DataFrame:
    """Last update and modification counter of every statistic."""
    return stamped(_named(stats, objects, scope), as_of).select(
        *scope, "DB_Name", "Table_Name", F.col("name").alias("Index_Name"), "LastUpdateDate",
        F.col("rowmodctr").cast("decimal(16,0)").alias("rowmodctr"), "Date",
    )


def table_usage(
    usage: DataFrame, indexes: DataFrame, objects: DataFrame, as_of, *, scope: Scope = ()
) -> DataFrame:
    """Reads, writes and their shares per user table, for tables that were read.

    Every index counts once per usage row of its object (the usage rows are not
    matched by index); an index without usage adds nothing.
    """
    keys = [*scope, "DB_Name", "object_id"]
    user_indexes = indexes.filter(
        (F.col("object_id") >= FIRST_USER_OBJECT) & (F.col("database_id") >= FIRST_USER_DATABASE)
    )
    # Repeating each usage row once per index of its object is a multiplication of the object's totals.
    repeats = user_indexes.groupBy(*keys).agg(F.count(F.lit(1)).alias("__indexes"))
    per_object = usage_totals(usage, keys, "user_seeks", "user_scans", "user_updates").join(repeats, keys)
    by_name = [*scope, F.col("DB_Name").alias("DatabaseName"), "TableName"]
    per_table = _named(per_object, objects, scope, "TableName").groupBy(*by_name).agg(
        *[F.sum(F.col(c) * F.col("__indexes")).alias(c) for c in USAGE_TOTALS]
    )
    return stamped(with_shares(per_table, [*scope, "DatabaseName", "TableName"]), as_of)


def routine_catalog(
    objects: DataFrame, plans: DataFrame, as_of, *, scope: Scope = (), name_only: bool = False
) -> DataFrame:
    """All procedures and functions with the use count of their cached plans.

    ``plans`` holds one row per cached plan with its object's database, schema and
    name. ``name_only`` matches plans by schema-less name across databases, which
    repeats a routine once per database and schema where the name occurs.
    """
    routines = objects.filter(F.col("type").isin(ROUTINE_TYPES))
    cached = plans.filter(F.col("plan_DB_Name").isNotNull() & (F.col("objtype") == "Proc"))
    group = [*scope, "plan_schema", "plan_name"] if name_only else [*scope, "plan_DB_Name", "plan_schema", "plan_name"]
    counts = cached.groupBy(*group).agg(F.sum("usecounts").cast("decimal(18,0)").alias("Execution_Count"))
    if name_only:
        keys = {"plan_name": "name"}
        counts = counts.drop("plan_schema")
    else:
        keys = {"plan_DB_Name": "DB_Name", "plan_schema": "schema_name", "plan_name": "name"}
    counts = counts.withColumnsRenamed(keys)
    joined = routines.join(counts, [*scope, *keys.values()], "left")
    return stamped(joined, as_of).select(
        *scope, "DB_Name", F.col("name").alias("SP_Name"), F.col("create_date").alias("Create_Date"),
        F.col("modify_date").alias("Modify_Date"), "Execution_Count", "Date",
    )


def routine_exec(
    procedures: DataFrame, stats: DataFrame, as_of, *, n: int = 200, scope: Scope = ()
) -> DataFrame:
    """Execution statistics of the ``n`` most executed procedures of each database."""
    keys = [*scope, "DB_Name", "object_id"]
    joined = stats.join(procedures.select(*keys, F.col("name").alias("SP Name")), keys)
    top = top_k_per(
        joined, [*scope, "DB_Name"], n, [F.desc("execution_count"), F.asc("SP Name"), F.asc("cached_time"),
                                         F.asc("total_elapsed_time")]
    )
    runs = F.col("execution_count")
    age = boundary_diff("second", F.col("cached_time"), ts_lit(as_of))
    return stamped(top, as_of).select(
        *scope, "DB_Name", "SP Name", "execution_count",
        F.coalesce(int_div(runs, age), F.lit(0)).alias("Calls/Second"),
        int_div("total_worker_time", runs).alias("AvgWorkerTime"), F.col("total_worker_time").alias("TotalWorkerTime"),
        "total_elapsed_time", int_div("total_elapsed_time", runs).alias("avg_elapsed_time"), "cached_time",
        F.col("total_logical_reads").alias("TotalLogicalReads"),
        int_div("total_logical_reads", runs).alias("AvgLogicalReads"),
        F.col("total_logical_writes").alias("TotalLogicalWrites"),
        int_div("total_logical_writes", runs).alias("AvgLogicalWrites"), "Date",
    )


def top_queries(
    stats: DataFrame, texts: DataFrame, plans: DataFrame, as_of, *, n: int = 25, scope: Scope = ()
) -> DataFrame:
    """The ``n`` statements with the longest mean run time, with text and plan.

    A statement needs a text but not a plan. The ranking runs over handles and
    numbers; texts and plans are joined to the ``n`` survivors only.
    """
    mean_ms = int_div(micros_to_millis("total_elapsed_time"), "execution_count")
    known = stats.join(texts.select(*scope, "sql_handle"), [*scope, "sql_handle"], "left_semi")
    ranked = top_k(
        known.withColumn("__mean", mean_ms), n,
        [F.desc("__mean"), *[F.asc(c) for c in (*scope, "sql_handle", "plan_handle", "statement_start_offset",
                                                "statement_end_offset", "creation_time")]],
    )
    wanted = F.broadcast(ranked)
    with_text = texts.join(wanted, [*scope, "sql_handle"])
    with_plan = plans.join(
        F.broadcast(ranked.select(*scope, "plan_handle").distinct()), [*scope, "plan_handle"], "left_semi"
    )
    joined = with_text.join(F.broadcast(with_plan.select(*scope, "plan_handle", "query_plan")),
                            [*scope, "plan_handle"], "left")
    reads = F.coalesce(int_div("total_physical_reads", "execution_count"), F.lit(0))
    return stamped(joined, as_of).select(
        *scope, F.col("object_name").alias("name"), "DB_Name", "execution_count", "total_logical_reads",
        "last_logical_reads", "total_logical_writes", "last_logical_writes",
        micros_to_seconds("total_elapsed_time").alias("total_elapsed_time_in_S"),
        micros_to_seconds("last_elapsed_time").alias("last_elapsed_time_in_S"),
        F.col("__mean").alias("AvgExecutionDuration1000sOfSeconds"), reads.alias("AvgPhysicalReads"),
        F.col("min_physical_reads").alias("MinPhysicalReads"), F.col("max_physical_reads").alias("MaxPhysicalReads"),
        pages_to_kb(reads).alias("AvgPhysicalReads_kbsize"),
        pages_to_kb("min_physical_reads").alias("MinPhysicalReads_kbsize"),
        pages_to_kb("max_physical_reads").alias("MaxPhysicalReads_kbsize"),
        F.col("creation_time").alias("CreationDateTime"), "last_execution_time",
        statement_slice("text", "statement_start_offset", "statement_end_offset").alias("query_text"), "query_plan",
        F.lit(False).alias("missing_index_info"), "Date",
    )


def index_usage(
    usage: DataFrame, indexes: DataFrame, objects: DataFrame, as_of, *, scope: Scope = ()
) -> DataFrame:
    """Seeks, scans, lookups and updates of every used index, matched within its own database."""
    named = _indexed(usage, indexes, objects, scope, F.col("name").alias("Index_Name"), "type_desc", "fill_factor", "is_primary_key")
    counters = ["user_seeks", "user_scans", "user_lookups", "user_updates"]
    return stamped(named, as_of).select(
        *scope, "DB_Name", "Table_Name", "Index_Name", *[F.col(c).cast("decimal(18,0)").alias(c) for c in counters],
        "last_user_seek", "last_user_scan", "last_user_lookup", "last_user_update", "type_desc",
        F.col("fill_factor").cast("decimal(18,0)").alias("fill_factor"), "is_primary_key", "Date",
    )


def buffer_space(buffers: DataFrame, keys: Sequence[str], *, min_pages: int = MIN_PAGES) -> DataFrame:
    """Pages, free bytes and their shares per allocation unit, clean and modified pages apart."""
    dirty, free = F.col("is_modified"), F.col("free_space_in_bytes").cast("bigint")
    # an unknown flag counts as a clean page
    flag = F.coalesce(dirty, F.lit(False))
    sums = buffers.groupBy(*keys).agg(
        F.sum(F.when(flag, 1).otherwise(0)).alias("DPCount"),
        F.sum(F.when(flag, 0).otherwise(1)).alias("CPCount"),
        F.sum(F.when(flag, free).otherwise(0)).alias("DPFreeSpace"),
        F.sum(F.when(flag, 0).otherwise(free)).alias("CPFreeSpace"),
    )
    pages, free_bytes = F.col("DPCount") + F.col("CPCount"), F.col("DPFreeSpace") + F.col("CPFreeSpace")
    percent = F.lit(100).cast("decimal(19,0)") * int_div(free_bytes, 1024) / (pages * 8)
    return sums.filter(pages > min_pages).select(
        *keys, "DPCount", "CPCount", "DPFreeSpace", "CPFreeSpace",
        pages_to_mb(pages).cast("int").alias("Total_MBs"),
        bytes_to_mb(free_bytes).cast("int").alias("Free_Space_MBs"),
        F.round(percent, 1).cast("decimal(4,1)").alias("Free_Space_Percent"),
    )


def index_free_space(
    buffers: DataFrame, units: DataFrame, partitions: DataFrame, indexes: DataFrame, objects: DataFrame, as_of, *,
    min_pages: int = MIN_PAGES, scope: Scope = (),
) -> DataFrame:
    """Free space in the buffered pages of large indexes, one row per allocation unit."""
    db = [*scope, "DB_Name"]
    space = buffer_space(buffers, [*db, "allocation_unit_id"], min_pages=min_pages)
    located = (
        space.join(units.select(*db, "allocation_unit_id", "container_id"), [*db, "allocation_unit_id"])
        .join(
            partitions.filter(F.col("object_id") >= FIRST_USER_OBJECT).select(
                *db, F.col("partition_id").alias("container_id"), "object_id", "index_id"
            ),
            [*db, "container_id"],
        )
    )
    return stamped(_indexed(located, indexes, objects, scope, "name", "type_desc"), as_of).select(
        *scope, "DB_Name", "Table_Name", F.col("index_id").alias("Index_ID"), F.col("name").alias("Index_Name"),
        F.col("type_desc").alias("Type"), "Total_MBs", "Free_Space_MBs", "Free_Space_Percent", "Date",
    )


def table_rows(objects: DataFrame, partitions: DataFrame, as_of, *, scope: Scope = ()) -> DataFrame:
    """Row count of every user table, from its heap or clustered index partitions."""
    keys = [*scope, "DB_Name", "object_id"]
    tables = objects.filter((F.col("type") == "U") & ~F.col("is_ms_shipped"))
    sizes = partitions.filter(F.col("index_id") < 2).groupBy(*keys).agg(F.sum("rows").alias("__rows"))
    joined = tables.join(sizes, keys).groupBy(*scope, "DB_Name", "schema_name", "name").agg(
        F.sum("__rows").alias("RowCount")
    )
    return stamped(joined, as_of).select(
        *scope, F.col("DB_Name").alias("DatabaseName"),
        F.concat(quotename("schema_name"), F.lit("."), quotename("name")).alias("TableNameFull"),
        F.col("name").alias("TableName"), "RowCount", "Date",
    )


def clean_statistics(statistics: DataFrame, *, quiet_servers: Sequence[str] = (), server: str | None = None) -> DataFrame:
    """Remove statistics of the temporary database, and unmodified ones on the listed servers.

    The list applies to ``server_name`` where the table has it, else to ``server``.
    """
    kept = drop_where(statistics, F.col("DB_Name") == "tempdb")
    if not quiet_servers:
        return kept
    name = F.col("server_name") if "server_name" in statistics.columns else F.lit(server)
    return drop_where(kept, (F.col("rowmodctr") == 0) & name.isin(list(quiet_servers)))


# ---------------------------------------------------------------- two-hourly: file I/O

IO_KEYS = ["serID", "dbID", "database_drive", "database_file_name"]
IO_COUNTERS = ["NumberReads", "NumberWrites", "MBsRead", "MBsWritten", "IoStallReadMS", "IoStallWriteMS"]


def file_io_snapshot(
    stats: DataFrame, files: DataFrame, databases: DataFrame, restart, as_of, *, scope: Scope = ()
) -> DataFrame:
    """Cumulative file counters with drive, file and database names. ``restart`` is the last start of the server."""
    keys = [*scope, "DbId", "FileId"]
    dim = files.select(
        *scope, F.col("database_id").alias("DbId"), F.col("file_id").alias("FileId"),
        F.left("physical_name", F.lit(1)).alias("database_drive"), F.col("name").alias("database_file_name"),
    )
    names = databases.select(*scope, F.col("database_id").alias("DbId"), F.col("name").alias("databasename"))
    return stats.join(dim, keys, "left").join(names, [*scope, "DbId"], "left").select(
        *scope, "databasename", "database_drive", "database_file_name", "NumberReads", "NumberWrites",
        bytes_to_mb("BytesRead").alias("MBsRead"), bytes_to_mb("BytesWritten").alias("MBsWritten"), "IoStallReadMS",
        "IoStallWriteMS", ts_lit(restart).alias("report_date_time_start"), ts_lit(as_of).alias("report_date_time_end"),
        ts_lit(restart).alias("TimeStamp"),
    )


def register_databases(known: DataFrame, servers: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Add the databases seen for the first time, once each, with the id of their server.

    ``dbID`` is a hash of server and database name, so that independent runs agree.
    """
    seen = snapshot.select("server_name", F.col("databasename").alias("database_name")).distinct()
    fresh = seen.filter(F.col("database_name").isNotNull()).join(servers.select("serID", "server_name"), "server_name")
    have = known.select("serID", "database_name").distinct()
    added = fresh.join(have, ["serID", "database_name"], "left_anti")
    given = {"serID", "server_name", "database_name"}
    return known.unionByName(
        added.select(
            *[
                F.col(f.name)
                if f.name in given
                else F.xxhash64("server_name", "database_name").cast(f.dataType).alias("dbID")
                if f.name == "dbID"
                else F.lit(None).cast(f.dataType).alias(f.name)
                for f in known.schema
            ]
        )
    )


def io_metrics(df: DataFrame) -> DataFrame:
    """Totals and mean stalls; a mean over no operations is 0."""
    return df.withColumns(
        {
            "TotalIO": F.col("NumberReads") + F.col("NumberWrites"),
            "TotalMBs": F.col("MBsRead") + F.col("MBsWritten"),
            "IoStallMS": F.col("IoStallReadMS") + F.col("IoStallWriteMS"),
            "AvgStallPerReadIO": guarded_div("IoStallReadMS", "NumberReads"),
            "AvgStallPerWriteIO": guarded_div("IoStallWriteMS", "NumberWrites"),
        }
    ).withColumn("AvgStallPerIO", guarded_div("IoStallMS", "TotalIO"))


def drop_bad_deltas(df: DataFrame) -> DataFrame:
    """Remove intervals with negative operation totals or a negative mean write stall."""
    return drop_where(df, (F.col("TotalIO") < 0) | (F.col("AvgStallPerWriteIO") < 0))


def file_io(snapshots: DataFrame, *, keys: Sequence[str] = IO_KEYS, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Interval I/O of every file from its cumulative snapshots, with derived metrics.

    The first snapshot after a restart counts from the restart; each later one
    from the snapshot before it.
    """
    deltas = counter_delta(
        snapshots, keys, "report_date_time_end", IO_COUNTERS, epoch="TimeStamp", hot_rows=hot_rows,
    )
    return _io_rows(deltas, keys)


def file_io_step(
    snapshot: DataFrame, last: DataFrame | None, *, keys: Sequence[str] = IO_KEYS, hot_rows: int | None = HOT_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Interval I/O of one new snapshot, given the last cumulative sample of each file, and the next last samples."""
    deltas, newest = counter_step(
        snapshot, last, keys, "report_date_time_end", IO_COUNTERS, epoch="TimeStamp", hot_rows=hot_rows
    )
    return _io_rows(deltas.filter(~F.col("late")), keys), newest


def file_io_continue(snapshot: DataFrame, stored: DataFrame, *, keys: Sequence[str] = IO_KEYS) -> DataFrame:
    """Interval I/O of one new snapshot, given stored intervals only.

    What a file has counted since the restart is the sum of its intervals that
    began after it; the new interval is the rest. A file without such intervals
    counts from the restart. ``snapshot`` holds one row per file. The oldest of its restarts
    (one value) bounds what is read of ``stored``, its day partitions too; within that, a file meets its own
    intervals since its own restart only.
    """
    keys = list(keys)
    oldest = snapshot.agg(F.min("TimeStamp").cast("timestamp_ntz").cast("string")).first()[0]
    if oldest is not None:
        stored = stored.filter(F.col("report_date_time_start") >= ts_lit(oldest))
        if PARTITION in stored.columns:
            stored = stored.filter(F.col(PARTITION).isNull() | (F.col(PARTITION) >= F.lit(oldest[:10]).cast("date")))
    spans = snapshot.select(*keys, F.col("TimeStamp").alias("__epoch"), F.col("report_date_time_end").alias("__end"))
    history = stored.select(*keys, *IO_COUNTERS, "report_date_time_start", "report_date_time_end")
    since = span_join(history, spans, keys, "report_date_time_start", "__epoch", "__end").filter(
        F.col("report_date_time_end") < F.col("__end")
    )
    counted = since.groupBy(*keys).agg(
        *[F.sum(c).alias(f"__sum_{c}") for c in IO_COUNTERS], F.max("report_date_time_end").alias("__last_end")
    )
    joined = snapshot.join(counted, keys, "left")
    return drop_bad_deltas(io_metrics(joined.select(
        *keys,
        *[(F.col(c) - F.coalesce(F.col(f"__sum_{c}"), F.lit(0))).alias(c) for c in IO_COUNTERS],
        F.coalesce("__last_end", "TimeStamp").alias("report_date_time_start"), "report_date_time_end", "TimeStamp",
    )))


def _io_rows(deltas: DataFrame, keys: Sequence[str]) -> DataFrame:
    shaped = deltas.select(
        *keys, *[F.col(f"{c}_delta").alias(c) for c in IO_COUNTERS],
        F.col("interval_start").alias("report_date_time_start"), "report_date_time_end", "TimeStamp",
    )
    return drop_bad_deltas(io_metrics(shaped))


# ---------------------------------------------------------------- two-hourly: counters

#: Fixed value: the elements of a ring-buffer record.
CPU_RECORD = "_id INT, SchedulerMonitorEvent STRUCT<SystemHealth: STRUCT<SystemIdle: INT, ProcessUtilization: INT>>"


def cpu_samples(ring: DataFrame, now_ms, as_of, *, hours=2, scope: Scope = ()) -> DataFrame:
    """Processor shares per minute from ring-buffer records; a missing value stays NULL."""
    ticks = _cpu_ticks("timestamp", now_ms, hours)
    texts = recent(ring.filter(ticks & F.col("record").contains("<SystemHealth>")).withColumn("Date", tick_time(as_of, now_ms, "timestamp")),
                   "Date", hours / 24, as_of)
    return _cpu_shares(texts.withColumn("x", F.from_xml("record", F.lit(CPU_RECORD))), "x.SchedulerMonitorEvent", scope)


def cpu_records(records: DataFrame, now_ms, as_of, *, hours=2, scope: Scope = ()) -> DataFrame:
    """The same from records read as XML files (:func:`landed.read_xml`), their ticks in the attribute ``timestamp``."""
    whole = F.col("SchedulerMonitorEvent.SystemHealth").isNotNull() & _cpu_ticks("_timestamp", now_ms, hours)
    dated = records.filter(whole).withColumn("Date", tick_time(as_of, now_ms, "_timestamp"))
    return _cpu_shares(recent(dated, "Date", hours / 24, as_of), "SchedulerMonitorEvent", scope)


def _cpu_ticks(ticks: str, now_ms, hours) -> Column:
    """The ticks themselves bound the scan, a minute wider than the exact times."""
    return F.col(ticks).between(now_ms - round(hours * 3_600_000) - 60_000, now_ms + 60_000)


def _cpu_shares(dated: DataFrame, event: str, scope: Scope) -> DataFrame:
    health = F.col(f"{event}.SystemHealth")
    idle, sql = health["SystemIdle"], health["ProcessUtilization"]
    return dated.select(
        *scope, "Date", sql.alias("SQLProcessUtilization"), idle.alias("SystemIdle"),
        (100 - idle - sql).alias("OtherProcessUtilization"),
    )


def batch_snapshot(counters: DataFrame, as_of, *, scope: Scope = ()) -> DataFrame:
    """Cumulative batch-request counters, stamped; rates are filled by :func:`batch_delta`."""
    wanted = counters.filter(F.col("counter_name").like("%Batch Requests/sec%"))
    return stamped(wanted, as_of).select(
        *scope, F.rtrim("object_name").alias("object_name"), F.rtrim("counter_name").alias("counter_name"),
        "cntr_value", "Date",
    )


def batch_delta(
    samples: DataFrame, *, keys: Sequence[str] = ("object_name", "counter_name"), hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Requests and seconds between consecutive samples of each counter.

    The first sample counts nothing. After a fall the previous value is counted, over zero seconds.
    """
    deltas = counter_delta(
        samples, keys, "Date", ["cntr_value"], on_reset="previous", first="zero", hot_rows=hot_rows
    )
    return deltas.select(
        *samples.columns, F.col("seconds").cast("int").alias("seconds"), F.col("cntr_value_delta").alias("requests")
    )


PACKET_COUNTERS = {
    "PacketsReceivedBase": "PacketsReceived", "PacketsSentBase": "PacketsSent", "PacketErrorsBase": "PacketErrors",
}


def packet_delta(samples: DataFrame, *, keys: Sequence[str] = (), hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Fill the interval columns of the packet counters. Use ``keys=['server_name']`` for a fleet."""
    df, by = (samples, list(keys)) if keys else (samples.withColumn("__one", F.lit(1)), ["__one"])
    deltas = counter_delta(df, by, "Date", list(PACKET_COUNTERS), first="zero", hot_rows=hot_rows)
    return deltas.select(
        *keys, *PACKET_COUNTERS, "Date", F.col("seconds").cast("int").alias("seconds"),
        *[F.col(f"{base}_delta").cast("int").alias(out) for base, out in PACKET_COUNTERS.items()],
    )


def delivery_rate(
    history: DataFrame, agents: DataFrame, as_of=None, *, hours=None, keep_newest: bool = False,
    scope: Scope = (), hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Commands delivered per minute by each agent between consecutive samples of one session.

    With ``hours`` only that window is used, as a first pass over fresh samples;
    without it the whole history is differenced again, which makes a repair pass
    unnecessary. The newest sample of an agent may still grow and is left out
    unless ``keep_newest``. A falling counter counts 0.
    """
    key = [*scope, "agent_id"]
    active = history.filter(F.col("delivered_commands") > 0)
    if hours is not None:
        active = recent(active, "time", hours / 24, as_of)
    lagged = with_previous(
        active, key, ["time", "delivered_commands"],
        {"__p_start": "start_time", "__p_time": "time", "__p_n": "delivered_commands"},
        is_last="__newest", hot_rows=hot_rows,
    )
    if not keep_newest:
        lagged = lagged.filter(~F.col("__newest"))
    same = F.coalesce(F.col("__p_start") == F.col("start_time"), F.lit(False))
    step = F.col("delivered_commands") - F.col("__p_n")
    seconds = F.when(same, boundary_diff("second", "__p_time", "time")).otherwise(0)
    commands = F.when(same & (step > 0), step).otherwise(0).cast("bigint")
    rate = F.when(F.col("seconds") > 0, per_minute(F.col("commands"), F.col("seconds"))).otherwise(0)
    named = lagged.join(agents.select(*scope, F.col("id").alias("agent_id"), "name"), key)
    return (
        named.withColumn("seconds", seconds)
        .withColumn("commands", commands)
        .select(
            *scope, "name", F.col("agent_id").alias("id"), "start_time", "runstatus", "time", "delivered_commands",
            F.col("seconds").cast("int").alias("seconds"), F.col("commands").cast("int").alias("commands"),
            rate.cast("int").alias("commands_per_Minute"), date_key("time").alias("DateKey"),
            F.hour("time").alias("Hour"), F.minute("time").alias("Minute"),
        )
    )


def _counter(name: str) -> Column:
    return F.rtrim("counter_name") == name


def _buffer_counter(name: str) -> Column:
    return F.rtrim("object_name").endswith("Buffer Manager") & _counter(name)


def memory_metrics() -> dict[str, Column]:
    """Predicates that pick each memory metric from landed counter rows.

    Operating-system and process values are landed as counters named after their source column.
    """
    # Metric names and the counters they are read from.
    return {
        "Total_Physical_Memory_KB": _counter("physical_memory_kb"),
        "Total_Physical_Memory_KB_Available": _counter("available_physical_memory_kb"),
        "Total_Virtual_Memory_KB": _counter("virtual_memory_kb"),
        "Total_Virtual_Memory_KB_Available": _counter("virtual_address_space_available_kb"),
        "Total_Page_File_Memory_KB": _counter("total_page_file_kb"),
        "Total_Page_File_Memory_KB_Available": _counter("available_page_file_kb"),
        "Total_System_Cache_Memory_KB_Available": _counter("system_cache_kb"),
        "Mem_Needed_KB_Per_Current_Workload": _counter("Target Server Memory (KB)"),
        "Mem_Used_KB_Maintaining_Connections": _counter("Connection Memory (KB)"),
        "Mem_Used_KB_Locks": _counter("Lock Memory (KB)"),
        "Mem_Used_KB_Dynamic_Cache": _counter("SQL Cache Memory (KB)"),
        "Mem_Used_KB_Query_Optimization": _counter("Optimizer Memory (KB)"),
        "Mem_Used_KB_Hash_Sort_Index_Operations": _counter("Granted Workspace Memory (KB)"),
        "Mem_Used_KB_Cursors": _counter("Cursor memory usage") & (F.rtrim("instance_name") == "_Total"),
        "Mem_Used_KB_SQLServer": _counter("physical_memory_in_use_kb"),
        "Locked_Pages_Used_SQLServer_KB": _counter("locked_page_allocations_kb"),
        "Total_VAS_KB": _counter("total_virtual_address_space_kb"),
        "Memory_Grants_Pending": F.rtrim("object_name").endswith("Memory Manager") & _counter("Memory Grants Pending"),
        "System_High_Memory_Signal_State": _counter("system_high_memory_signal_state"),
        "System_Low_Memory_Signal_State": _counter("system_low_memory_signal_state"),
        "Process_Physical_Memory_Low": _counter("process_physical_memory_low"),
        "Process_Virtual_Memory_Low": _counter("process_virtual_memory_low"),
        "Free_List_Stalls_Per_Sec": _buffer_counter("Free list stalls/sec"),
        "Checkpoint_Pages_Per_Sec": _buffer_counter("Checkpoint pages/sec"),
        "Lazy_Writes_Per_Sec": _buffer_counter("Lazy writes/sec"),
    }


MEMORY_SIGNALS = [
    "System_High_Memory_Signal_State", "System_Low_Memory_Signal_State", "Process_Physical_Memory_Low",
    "Process_Virtual_Memory_Low",
]


def memory_snapshot(counters: DataFrame, as_of, *, scope: Scope = (), bytes_source: bool = False) -> DataFrame:
    """One wide memory row per server from its counter rows.

    ``bytes_source`` is for older servers, which report the two totals in bytes
    and store them divided by 8192, rounded up.
    """
    if bytes_source:
        in_bytes = F.rtrim("counter_name").isin("physical_memory_in_bytes", "virtual_memory_in_bytes")
        counters = counters.select(
            *scope, "object_name", "instance_name",
            F.when(in_bytes, F.replace(F.rtrim("counter_name"), F.lit("_in_bytes"), F.lit("_kb")))
            .otherwise(F.col("counter_name")).alias("counter_name"),
            F.when(in_bytes, F.ceil(int_div("cntr_value", 8192))).otherwise(F.col("cntr_value")).alias("cntr_value"),
        )
    wide = pivot_counters(counters, list(scope), "counter_name", "cntr_value", memory_metrics())
    return stamped(wide.withColumns({c: F.col(c).cast("boolean") for c in MEMORY_SIGNALS}), as_of)


def page_life(counters: DataFrame, as_of, *, scope: Scope = ()) -> DataFrame:
    """Seconds a page stays in the buffer pool."""
    wanted = counters.filter((F.rtrim("object_name") == "SQLServer:Buffer Manager") & _counter("Page life expectancy"))
    return stamped(wanted, as_of).select(
        *scope, F.col("cntr_value").cast("int").alias("Page_Life_Expectancy"), "Date"
    )


def hit_ratio(counters: DataFrame, as_of, *, scope: Scope = ()) -> DataFrame:
    """Buffer cache hit ratio; a missing or zero base gives no row."""
    manager = F.rtrim("object_name") == "SQLServer:Buffer Manager"
    ratio = counter_ratio(
        counters, list(scope), "cntr_value", manager & _counter("Buffer cache hit ratio"),
        manager & _counter("Buffer cache hit ratio base"), "Buffer_Cache_Hit_Ratio",
    )
    return stamped(ratio.withColumn("Buffer_Cache_Hit_Ratio", F.col("Buffer_Cache_Hit_Ratio").cast("decimal(5,3)")), as_of)


# ---------------------------------------------------------------- two-hourly: job runs

JOB_COLUMNS = [
    "JobName", "JobFailStep", "JobFailMessage", "RunDateTime", "JobDurationSeconds", "RunStatus", "owner", "source",
    "Date",
]


def agent_jobs(
    jobs: DataFrame, runs: DataFrame, as_of, *, hours=2, name_length: int | None = 60, scope: Scope = ()
) -> DataFrame:
    """Scheduler job steps that ended in the last ``hours``, decoded from packed dates, times and durations.

    Names are cut to ``name_length`` as the source reports them; ``None`` keeps them whole.
    """
    name = F.col("name") if name_length is None else F.substring("name", 1, name_length)
    seconds = packed_seconds("run_duration")
    start = packed_datetime("run_date", "run_time")
    joined = jobs.join(runs, [*scope, "job_id"]).select(
        *scope, name.alias("JobName"), F.col("step_id").alias("JobFailStep"),
        message_tail("message").alias("JobFailMessage"), start.alias("RunDateTime"),
        seconds.alias("JobDurationSeconds"), F.col("run_status").alias("RunStatus"),
        F.lit(None).cast("string").alias("owner"), F.lit("SQLAgent").alias("source"), ts_lit(as_of).alias("Date"),
    )
    ended = add_seconds("RunDateTime", "JobDurationSeconds")
    return joined.filter(ended >= ts_lit(days_before(as_of, hours / 24)))


def report_jobs(log: DataFrame, as_of, *, hours=2, scope: Scope = ()) -> DataFrame:
    """Report executions that ended in the last ``hours``."""
    spent = F.col("TimeDataRetrieval") + F.col("TimeProcessing") + F.col("TimeRendering")
    return recent(log, "TimeEnd", hours / 24, as_of).select(
        *scope, F.col("ReportPath").alias("JobName"), F.lit(1).alias("JobFailStep"),
        F.col("Parameters").alias("JobFailMessage"), F.col("TimeStart").alias("RunDateTime"),
        millis_to_seconds(spent).cast("int").alias("JobDurationSeconds"),
        F.when(F.col("Status") == "rsSuccess", 1).otherwise(0).alias("RunStatus"), F.col("UserName").alias("owner"),
        F.lit("SSRS").alias("source"), ts_lit(as_of).alias("Date"),
    )


def etl_jobs(stats: DataFrame, as_of, *, hours=2, scope: Scope = ()) -> DataFrame:
    """Package executions that ended in the last ``hours``; result 0 means success."""
    return recent(stats, "end_time", hours / 24, as_of).select(
        *scope, F.col("execution_path").alias("JobName"), F.lit(1).alias("JobFailStep"),
        F.lit("").alias("JobFailMessage"), F.col("start_time").alias("RunDateTime"),
        millis_to_seconds("execution_duration").cast("int").alias("JobDurationSeconds"),
        F.when(F.col("execution_result") == 0, 1).otherwise(0).alias("RunStatus"),
        F.lit(None).cast("string").alias("owner"), F.lit("SSIS").alias("source"), ts_lit(as_of).alias("Date"),
    )


def unified_jobs(*sources: DataFrame) -> DataFrame:
    """All job runs in one table; each row carries its source."""
    out = sources[0]
    for df in sources[1:]:
        out = out.unionByName(df)
    return out


# ---------------------------------------------------------------- on demand: locks

def lock_enrich(
    locks: DataFrame, requests: DataFrame, texts: DataFrame, sessions: DataFrame, as_of, *, scope: Scope = ()
) -> DataFrame:
    """Locks with the blocking session and statement of the holder's request, and its session details."""
    asked = requests.join(texts.select(*scope, "sql_handle", "text"), [*scope, "sql_handle"]).select(
        *scope, F.col("session_id").alias("spid"), "blocking_session_id", "text"
    )
    who = sessions.select(
        *scope, F.col("session_id").alias("spid"), "host_name", "program_name", "login_name", "login_time"
    )
    key = [*scope, "spid"]
    joined = locks.join(asked, key, "left").join(who, key, "left")
    return joined.select(
        *[F.rtrim(c).alias(c) if t == "string" else F.col(c) for c, t in locks.dtypes],
        "blocking_session_id", "text", "host_name", "program_name", "login_name", "login_time",
        ts_lit(as_of).alias("DateTime"),
    )


def lock_hotspots(locks: DataFrame, objects: DataFrame, databases: DataFrame, *, scope: Scope = ()) -> DataFrame:
    """Locks and blocked requests per object, without change-tracking tables and the temporary database.

    Counting comes first: names are joined to one row per object.
    """
    counted = locks.groupBy(*scope, F.col("dbid").alias("database_id"), F.col("objId").alias("object_id")).agg(
        F.count("objId").alias("Locks"), F.count("blocking_session_id").alias("Blocked")
    )
    dbs = databases.filter(F.col("name") != "tempdb").select(*scope, "database_id", F.col("name").alias("DB_Name"))
    named = objects.filter(~F.col("name").like("change_tracking%")).select(
        *scope, "DB_Name", "object_id", F.col("name").alias("ObjectName")
    )
    return counted.join(dbs, [*scope, "database_id"]).join(named, [*scope, "DB_Name", "object_id"]).select(
        *scope, "DB_Name", "ObjectName", "Locks", "Blocked"
    )
