"""Named queries: every report, collector and operator over whole sample tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import timeparts as tp
from ..operators import bounds, counters, joins, ordered, rollup, timewindow
from ..operators.timewindow import PARTITION
from ..plans import alerts, collect, parameters, reports, runner, worklists
from ..sources import history, landed, moments
from ..sources.colocated import buckets_for, co_locate, keys_of
from ..sources.scratch import scratch, stored
from . import replay
from . import roles as r
from .roles import EVENTS_AT, SALES_AT, Tables

Query = Callable[[Tables], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def plain(df: DataFrame, digits: int = 6) -> DataFrame:
    """Types any engine shares: decimals and floats as rounded doubles, dates as text."""
    out = []
    for f in df.schema:
        kind, c = f.dataType.simpleString(), F.col(f"`{f.name}`")
        if kind.startswith("decimal") or kind in ("double", "float"):
            c = F.round(c.cast("double"), digits)
        elif kind == "date":
            c = c.cast("string")
        out.append(c.alias(f.name))
    return df.select(*out)


# ---------------------------------------------------------------- bounds and outliers

@query
def job_bounds(t):
    return reports.job_bounds(r.jobs(t))


@query
def job_outliers(t):
    return reports.job_outliers(r.jobs(t), EVENTS_AT)


@query
def job_outlier_summary(t):
    return reports.job_outlier_summary(r.jobs(t), EVENTS_AT)


@query
def routine_bounds(t):
    return plain(reports.routine_bounds(r.routine_exec(t)), 2)


@query
def routine_outliers(t):
    return plain(reports.routine_outliers(r.routine_exec(t), SALES_AT), 2)


@query
def routine_outlier_summary(t):
    return plain(reports.routine_outlier_summary(r.routine_exec(t), SALES_AT, days=365), 2)


# ---------------------------------------------------------------- roll-ups

@query
def jobs_weekly(t):
    return reports.jobs_weekly(r.jobs(t))


@query
def jobs_detail(t):
    return reports.jobs_detail(r.jobs(t))


@query
def routine_weekly(t):
    return reports.routine_weekly(r.routine_exec(t))


@query
def routine_detail(t):
    return reports.routine_detail(r.routine_exec(t))


@query
def batch_volumes(t):
    samples = collect.batch_delta(r.batch_samples(t))
    return reports.batch_volumes(samples.withColumn("counter_name", F.lit("Batch Requests/sec")))


@query
def usage_share(t):
    return r.table_usage(t)


@query
def io_calendar(t):
    return reports.io_calendar(collect.io_metrics(r.io_intervals(t)), r.databases(t))


@query
def io_per_day(t):
    return reports.io_per_day(collect.io_metrics(r.io_intervals(t)), r.databases(t))


@query
def table_row_counts(t):
    return reports.table_row_counts(r.table_rows(t), SALES_AT)


@query
def table_row_trend(t):
    return reports.table_row_trend(r.table_rows(t))


@query
def unchanged_tables(t):
    return reports.unchanged_tables(r.table_rows(t))


@query
def routine_scripts(t):
    return reports.routine_scripts(r.modules(t), r.module_objects(t))


# ---------------------------------------------------------------- joins over history

@query
def indexes_with_scans(t):
    return reports.indexes_with_scans(r.index_usage(t), r.table_rows(t), SALES_AT)


@query
def tables_with_row_count(t):
    return reports.tables_with_row_count(r.table_usage(t), r.table_rows(t), SALES_AT)


@query
def tables_with_row_count_latest(t):
    return reports.tables_with_row_count(r.table_usage(t), r.table_rows(t), SALES_AT, latest=True)


@query
def tables_with_statistics(t):
    return reports.tables_with_statistics(r.table_usage(t), r.table_rows(t), r.statistics(t), SALES_AT)


def _co_located(t, role, table, buckets):
    """A role as a table bucketed by database and table; the names are new for each run."""
    where = scratch(t.spark, table)
    return co_locate(role(t), f"statledger_{table}_{where.rsplit('/', 1)[1]}", keys_of(table), where, buckets=buckets)


@query
def tables_with_statistics_co_located(t):
    buckets = buckets_for(r.table_rows(t), r.statistics(t))  # usage has a row a table at most, fewer than its row counts
    used, rows = _co_located(t, r.table_usage, "table_usage", buckets), _co_located(t, r.table_rows, "table_rows", buckets)
    return reports.tables_with_statistics(used, rows, _co_located(t, r.statistics, "statistics", buckets), SALES_AT)


@query
def stale_statistics(t):
    return reports.stale_statistics(r.table_usage(t), r.table_rows(t), r.statistics(t), SALES_AT, threshold=5_000)


@query
def fragmented_top_tables(t):
    return reports.fragmented_top_tables(r.fragmentation(t), r.table_usage(t), SALES_AT)


@query
def indexes_with_free_space(t):
    return reports.indexes_with_free_space(r.free_space(t), r.table_usage(t), r.table_rows(t), SALES_AT)


@query
def indexes_with_free_space_as_written(t):
    return reports.indexes_with_free_space(
        r.free_space(t), r.table_usage(t), r.table_rows(t), SALES_AT, as_written=True
    )


@query
def unneeded_indexes(t):
    return reports.unneeded_indexes(r.index_usage(t), SALES_AT)


@query
def unused_tables(t):
    return reports.unused_tables(r.table_rows(t), _usage_per_index(t), SALES_AT)


@query
def unused_tables_as_written(t):
    return reports.unused_tables(r.table_rows(t), _usage_per_index(t), SALES_AT, as_written=True)


@r.once
def _usage_per_index(t):
    """Usage rows per index; tables of the other part of the databases have none."""
    return r.index_usage(t).select(
        F.col("DB_Name").alias("DatabaseName"), F.col("Table_Name").alias("TableName"),
        F.col("user_seeks").alias("TotalAccesses"), "Date",
    )


# ---------------------------------------------------------------- counters

@query
def counter_delta(t):
    deltas = counters.counter_delta(
        r.io_samples(t), ["dbID"], "report_date_time_end", ["NumberReads", "IoStallReadMS"], epoch="TimeStamp",
        tie=["NumberReads"],
    )
    return deltas.select(
        "dbID", "NumberReads", "NumberReads_delta", "IoStallReadMS_delta", "interval_start", "seconds"
    )


@query
def file_io(t):
    return collect.file_io(r.io_samples(t))


@query
def file_io_continue(t):
    """The newest sample of each file, continued from the intervals before it."""
    samples = r.io_samples(t)
    newest = ordered.latest_per(samples, collect.IO_KEYS, "report_date_time_end")
    before = samples.join(newest.select(*collect.IO_KEYS, "report_date_time_end"), [*collect.IO_KEYS, "report_date_time_end"], "left_anti")
    return collect.file_io_continue(newest, collect.file_io(before))


@query
def file_io_in_steps(t):
    """Samples that arrive in three parts of the month, each step given only the last sample of each file; undated ones come first."""
    samples, last, parts = r.io_samples(t), None, []
    week, (second, third) = F.col("TimeStamp"), (tp.ts_lit("2024-01-08 00:00:00"), tp.ts_lit("2024-01-22 00:00:00"))
    for number, cut in enumerate((week.isNull() | (week < second), (week >= second) & (week < third), week >= third)):
        rows, newest = collect.file_io_step(samples.filter(cut), last)
        last = stored(newest, f"io_{number}")
        parts.append(rows)
    return reduce(DataFrame.unionByName, parts)


@query
def batch_snapshot(t):
    """The batch counters among all counters of the servers."""
    padded = r.batch_samples(t).select(
        F.rpad("object_name", 40, " ").alias("object_name"), F.rpad("counter_name", 60, " ").alias("counter_name"), "cntr_value")
    others = r.counter_rows(t).select("object_name", "counter_name", "cntr_value")
    return collect.batch_snapshot(padded.unionByName(others), EVENTS_AT)


@query
def batch_delta(t):
    return collect.batch_delta(r.batch_samples(t))


@query
def packet_delta(t):
    return collect.packet_delta(r.packet_samples(t), keys=["server_name"])


@query
def delivery_rate(t):
    return collect.delivery_rate(r.delivery_history(t), r.agents(t))


@query
def delivery_rate_first_pass(t):
    return collect.delivery_rate(r.delivery_history(t), r.agents(t), EVENTS_AT, hours=48)


@query
def memory_snapshot(t):
    return collect.memory_snapshot(r.counter_rows(t), EVENTS_AT, scope=["server_name", "day"])


@query
def memory_snapshot_in_bytes(t):
    """Servers of the older kind, which report their physical and virtual memory in bytes."""
    name = F.rtrim("counter_name")
    older = F.when(name == "Page life expectancy", "physical_memory_in_bytes").when(
        name == "Buffer cache hit ratio", "virtual_memory_in_bytes").otherwise(F.col("counter_name"))
    counters = r.counter_rows(t).withColumns({"cntr_value": F.col("cntr_value") * 1000, "counter_name": F.rpad(older, 40, " ")})
    return collect.memory_snapshot(counters, EVENTS_AT, scope=["server_name", "day"], bytes_source=True)


@query
def page_life(t):
    return collect.page_life(r.counter_rows(t), EVENTS_AT, scope=["server_name", "day"])


@query
def hit_ratio(t):
    return collect.hit_ratio(r.counter_rows(t), EVENTS_AT, scope=["server_name", "day"])


@query
def cpu_samples(t):
    return collect.cpu_samples(r.ring_records(t), 200_000_000, EVENTS_AT, hours=24)


# ---------------------------------------------------------------- job sources

@r.once
def _agent(t):
    return collect.agent_jobs(r.agent_job_names(t), r.agent_runs(t), SALES_AT, hours=24 * 365)


@query
def agent_jobs(t):
    return _agent(t)


@query
@r.once
def report_jobs(t):
    return collect.report_jobs(r.report_log(t), EVENTS_AT, hours=24 * 7)


@query
def etl_jobs(t):
    return collect.etl_jobs(r.etl_stats(t), SALES_AT, hours=24 * 30)


@query
def unified_jobs(t):
    return collect.unified_jobs(_agent(t), report_jobs(t), etl_jobs(t))


# ---------------------------------------------------------------- collectors

@query
def server_dim(t):
    return collect.server_dim(r.servers(t), r.probes(t))


@query
def fragmentation_snapshot(t):
    return collect.fragmentation(r.physical_extract(t), r.indexes(t), r.objects(t), SALES_AT)


@query
def statistics_snapshot(t):
    return collect.statistics(r.statistics_extract(t), r.objects(t), SALES_AT)


@query
def table_usage(t):
    return collect.table_usage(r.usage_extract(t), r.indexes(t), r.objects(t), SALES_AT)


@query
def routine_catalog(t):
    return collect.routine_catalog(r.objects(t), r.cached_plans(t), SALES_AT)


@query
def routine_catalog_by_name(t):
    return collect.routine_catalog(r.objects(t), r.cached_plans(t), SALES_AT, name_only=True)


@query
def routine_exec(t):
    return collect.routine_exec(r.procedures(t), r.procedure_stats(t), SALES_AT)


@query
def top_queries(t):
    return collect.top_queries(r.query_stats(t), r.query_texts(t), r.query_plans(t), SALES_AT)


@query
def index_usage_snapshot(t):
    return collect.index_usage(r.usage_extract(t), r.indexes(t), r.objects(t), SALES_AT)


@query
def index_free_space(t):
    return collect.index_free_space(
        r.buffers(t), r.allocation_units(t), r.unit_partitions(t), r.unit_indexes(t), r.unit_objects(t), SALES_AT,
        min_pages=128,
    )


@query
def buffer_space(t):
    return collect.buffer_space(r.buffers(t), ["DB_Name"], min_pages=0)


@query
def table_rows_snapshot(t):
    return collect.table_rows(r.objects(t), r.partition_rows(t), SALES_AT)


@query
def clean_statistics(t):
    return collect.clean_statistics(r.statistics(t))


@query
def clean_statistics_listed(t):
    """A fleet in which two servers keep no unmodified statistics."""
    modified = F.when(F.col("rowmodctr") % 3 == 0, F.lit(0)).otherwise(F.col("rowmodctr")).cast("decimal(16,0)")
    fleet = r.statistics(t).withColumns({"rowmodctr": modified, "server_name": F.replace("DB_Name", F.lit("db_"), F.lit("server_"))})
    return collect.clean_statistics(fleet, quiet_servers=["server_1", "server_3"])


@query
def file_io_snapshot(t):
    return collect.file_io_snapshot(
        r.io_stats(t), r.io_files(t), r.io_databases(t), "2001-07-01 00:00:00", SALES_AT
    )


@query
def register_databases(t):
    everything = r.databases(t)
    known = everything.join(t.supplier.filter("s_acctbal > 5000"), F.col("dbID") == F.col("s_suppkey"), "left_semi")
    snapshot = r.databases(t).select("server_name", F.col("database_name").alias("databasename"))
    snapshot = snapshot.unionByName(snapshot)  # one row per file
    servers = everything.select("serID", "server_name").distinct()
    return collect.register_databases(known, servers, snapshot).drop("dbID")


# ---------------------------------------------------------------- alerts

@r.once
def _runs(t):
    return alerts.recent_runs(
        r.user_procedures(t), r.user_runs(t), EVENTS_AT, exclusions=r.exclusions(t), days=30
    )


@r.once
def _run_bounds(t):
    return reports.routine_bounds(r.user_history(t))


@query
def recent_runs(t):
    return _runs(t)


@query
def long_runs(t):
    return alerts.long_runs(_runs(t), _run_bounds(t))


@query
def repeat_offenders(t):
    return alerts.repeat_offenders(_runs(t), _run_bounds(t))


@query
def alert_detail(t):
    return alerts.shown(alerts.offences(_runs(t), _run_bounds(t)))


@query
def alert_detail_of_flagged(t):
    """The same by way of a list of flagged names."""
    limits, runs = _run_bounds(t), _runs(t)
    return alerts.alert_detail(runs, limits, alerts.repeat_offenders(runs, limits))


# ---------------------------------------------------------------- worklists

# The week's usage and row counts and their join are stored, as every ranking starts from them.

@r.once
def _used(t):
    return stored(timewindow.recent(r.table_usage(t), "Date", reports.WEEK, SALES_AT), "week_of_usage")


@r.once
def _rows(t):
    return stored(timewindow.recent(r.table_rows(t), "Date", reports.WEEK, SALES_AT), "week_of_rows")


@r.once
def _sized(t):
    return stored(reports.tables_with_row_count(_used(t), _rows(t), SALES_AT), "sized_tables")


@r.once
def _spacious(t):
    return reports.indexes_with_free_space(r.free_space(t), _used(t), _rows(t), SALES_AT)


@r.once
def _table_candidates(t):
    stale = reports.stale_of(reports.with_statistics(_sized(t), r.statistics(t), SALES_AT), SALES_AT, threshold=5_000)
    broken = reports.fragmented_top_tables(r.fragmentation(t), _used(t), SALES_AT)
    return worklists.table_candidates(_sized(t), stale, broken, _spacious(t), SALES_AT)


@r.once
def _index_candidates(t):
    return worklists.index_candidates(r.index_usage(t), _spacious(t), SALES_AT)


@query
def table_candidates(t):
    return _table_candidates(t)


@query
def index_candidates(t):
    return _index_candidates(t)


@query
def enrich_candidates(t):
    return worklists.enrich_candidates(_table_candidates(t), _used(t), _rows(t), SALES_AT)


@r.once
def _commands(t):
    used, rows = _used(t), _rows(t)
    tables = stored(worklists.enrich_candidates(_table_candidates(t), used, rows, SALES_AT), "table_work")  # read twice by the commands
    indexes = worklists.enrich_candidates(_index_candidates(t), used, rows, SALES_AT)
    return worklists.rebuild_commands(tables, indexes, 100_000, 3_000_000)


@query
def rebuild_commands(t):
    return _commands(t)


def _work(t):
    return worklists.rebuild_work(
        r.table_usage(t), r.table_rows(t), r.statistics(t), r.fragmentation(t), r.free_space(t), r.index_usage(t), SALES_AT
    )


@query
def rebuild_worklist(t):
    commands = worklists.commands_of(_work(t), 100_000, 3_000_000)
    return rollup.joined_text(commands, ["DBName", "TableName"], "Command", "Worklist")


@query
def rebuild_worklist_offline(t):
    """The same work for an edition that cannot rebuild online, with four processors a command."""
    commands = worklists.commands_of(_work(t), 100_000, 3_000_000, online=False, maxdop=4)
    return rollup.joined_text(commands, ["DBName", "TableName"], "Command", "Worklist")


@query
def recommend_run(t):
    """Rebuild and statistics commands from history tables that were stored before."""
    root = scratch(t.spark, "recommend")
    loads = {"table_usage": r.table_usage, "table_rows": r.table_rows, "statistics": r.statistics, "fragmentation": r.fragmentation,
             "index_free_space": r.free_space, "index_usage": r.index_usage}
    for table, role in loads.items():
        history.append_snapshot(role(t), root, table, SALES_AT)
    rebuilds, refreshes = runner.run_recommend(
        t.spark, root, SALES_AT, max_rows=100_000, max_index_rows=3_000_000, percent_modified=400, stats_max_rows=45_000_000,
        min_modified=450_000)
    refreshes = refreshes.select(
        F.col("Database_Name").alias("DBName"), F.col("Table_Name").alias("TableName"), F.lit("statistics").alias("level"), "Command")
    return rebuilds.unionByName(refreshes)


@r.once
def _modified(t):
    return worklists.modified_percent(r.table_rows(t), r.statistics(t), r.table_usage(t), SALES_AT)


@query
def modified_percent(t):
    return _modified(t)


@query
def stats_commands(t):
    return worklists.stats_worklist(_modified(t), 400, 45_000_000, 450_000)


@query
def stats_worklist(t):
    commands = worklists.stats_worklist(_modified(t), 400, 45_000_000, 450_000)
    return rollup.joined_text(commands, ["Database_Name", "Table_Name"], "Command", "Worklist")


# ---------------------------------------------------------------- locks

@r.once
def _locks(t):
    return collect.lock_enrich(r.lock_rows(t), r.requests(t), r.request_texts(t), r.sessions(t), EVENTS_AT)


@query
def lock_enrich(t):
    return _locks(t)


@query
def lock_hotspots(t):
    return collect.lock_hotspots(_locks(t), r.lock_objects(t), r.lock_databases(t))


# ---------------------------------------------------------------- operators on their own

@query
def calendar_keys(t):
    ts = "o_orderdate"
    return t.orders.select(
        "o_orderkey", tp.year_week(ts).alias("YearWeek"), tp.date_key(ts).alias("DateKey"),
        F.dayofweek(ts).alias("DayOfWeekday"), tp.weekday_name(ts).alias("Weekday"), F.hour(ts).alias("Hour"),
        tp.midnight(ts).alias("End_Date"),
    )


@query
def boundary_diffs(t):
    pairs = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    events = t.events.withColumn("start", tp.ts_lit("2024-01-01 00:00:59"))
    shipped = pairs.select("l_orderkey", *[
        tp.boundary_diff(u, "o_orderdate", "l_shipdate").alias(f"{u}s") for u in ("second", "minute", "hour", "day")
    ])
    logged = events.select("event_id", *[
        tp.boundary_diff(u, "start", "ts").alias(f"{u}s") for u in ("second", "minute", "hour", "day")
    ])
    return shipped.withColumnRenamed("l_orderkey", "id").union(logged)


@query
def recent_events(t):
    return timewindow.recent(t.events, "ts", 6.9, EVENTS_AT)


@query
def retained_events(t):
    return timewindow.apply_retention(t.events, 14, EVENTS_AT, "ts")


@query
def kept_events(t):
    bad = (F.col("event_type") == "error") & (F.col("value") < 10)
    return timewindow.drop_where(t.events, bad)


@query
def seeded_settings(t):
    """Users seen in the events are configured; all other customers get the default."""
    current = t.events.select(F.col("user_id").alias("key")).distinct().withColumn("item", F.lit("set"))
    seeds = t.customer.select(F.col("c_custkey").alias("key"), F.lit("default").alias("item"))
    return joins.seed_missing(current, seeds, ["key"])


@query
def upserted_customers(t):
    """Customers changed by their latest event, with suppliers as new keys."""
    old = t.customer.select(
        "c_custkey", F.col("c_mktsegment").alias("segment"), tp.ts_lit("2000-01-01 00:00:00").alias("stamp")
    )
    latest = ordered.latest_per(t.events.select("user_id", "event_id", "event_type"), ["user_id"], "event_id")
    changed = latest.select(F.col("user_id").alias("c_custkey"), F.col("event_type").alias("segment"))
    added = t.supplier.select((-1 - F.col("s_suppkey")).alias("c_custkey"), F.lit("SUPPLIER").alias("segment"))
    return joins.upsert(old, changed.unionByName(added), ["c_custkey"], "stamp", tp.ts_lit(EVENTS_AT))


@query
def updated_from_orders(t):
    target = t.customer.select("c_custkey", "c_mktsegment", F.lit(-1.0).alias("o_totalprice"))
    source = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    return joins.update_from(target, source, ["c_custkey"], ["o_totalprice"], newest_by="o_orderdate")


@query
def orders_with_customer(t):
    customers = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    facts = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return joins.lookup_join(facts, customers, ["o_custkey"], "left")


@query
def never_ordered(t):
    current = timewindow.recent(t.orders, "o_orderdate", 365, SALES_AT).select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.select("c_custkey", "c_name").join(current, "c_custkey", "left_anti")


@query
def top_orders_per_customer(t):
    order = [F.desc("o_totalprice"), F.asc("o_orderkey")]
    facts = t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    return ordered.top_k_per(facts, ["o_custkey"], 3, order)


@query
def latest_order_per_customer(t):
    return ordered.latest_per(t.orders.select("o_custkey", "o_orderdate", "o_orderkey"), ["o_custkey"], "o_orderdate")


@query
def previous_event(t):
    facts = t.events.select("user_id", "ts", "event_id", "event_type")
    return ordered.with_previous(
        facts, ["user_id"], ["ts", "event_id"], {"prev_id": "event_id", "prev_type": "event_type"}, is_last="newest"
    )


# The same with limits so low that the ordinary keys count as hot.

@query
def previous_event_hot_keys(t):
    facts = t.events.select("user_id", "ts", "event_id", "event_type")
    return ordered.with_previous(
        facts, ["user_id"], ["ts", "event_id"], {"prev_id": "event_id", "prev_type": "event_type"}, is_last="newest",
        hot_rows=20,
    )


@query
def delivery_rate_hot_keys(t):
    return collect.delivery_rate(r.delivery_history(t), r.agents(t), hot_rows=20)


@query
def orders_with_customer_hot_keys(t):
    customers = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    facts = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return joins.lookup_join(facts, customers, ["o_custkey"], "left", hot_rows=10)


@query
def job_outliers_hot_keys(t):
    return reports.job_outliers(r.jobs(t), EVENTS_AT, hot_rows=300)


@query
def fleet_job_outliers(t):
    """Jobs of many servers in one table."""
    fleet = r.jobs(t).join(r.job_servers(t), "owner")
    return reports.job_outliers(fleet, EVENTS_AT, scope=["server_name"])


@query
def event_bounds_exact_keys(t):
    return bounds.sigma_bounds(t.events.withColumn("cents", r.cents("value")), ["event_type", "user_id"], "cents")


@query
def tagged_amounts(t):
    return joins.union_tagged(
        {
            "order": t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount")),
            "line": t.lineitem.select(F.col("l_orderkey").alias("id"), F.col("l_extendedprice").alias("amount")),
        },
        "source",
    ).groupBy("source", "id").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("amount"), 2).alias("amount"))


# ---------------------------------------------------------------- stored history, settings and whole runs

LOADED, LATER, CUT = "2024-01-15 12:00:00", "2024-01-16 12:00:00", "2024-01-16 06:00:00"


def _stored_rows(t, *loads):
    """table_rows after loads of (as_of, frame), read back."""
    root = scratch(t.spark, "rows")
    for as_of, frame in loads:
        history.append_snapshot(frame, root, "table_rows", as_of)
    return history.read_history(t.spark, root, "table_rows").drop(PARTITION)


@query
def history_rerun(t):
    """A load of all rows twice, run again with each row once, beside a load of another time."""
    rows = r.table_rows(t)
    return _stored_rows(t, (LOADED, rows.union(rows)), (LATER, rows), (LOADED, rows))


@query
def history_rerun_empty(t):
    """A load that is run again and has no rows any more."""
    rows = r.table_rows(t)
    return _stored_rows(t, (LOADED, rows), (LATER, rows), (LOADED, rows.limit(0)))


@query
def history_as_of(t):
    """Streamed events, and orders loaded before and after the time asked for, from one table."""
    root = scratch(t.spark, "as_of")
    replay.ingest_runs(t.spark, t.folder, root)
    orders = t.orders.select(
        F.lit("orders").alias("DB_Name"), F.col("o_orderpriority").alias("SP_Name"), F.col("o_orderkey").alias("last_elapsed_time"),
        F.when(F.col("o_orderkey") % 7 > 0, F.col("o_orderdate")).alias("Date"),
    )
    for as_of in (LOADED, LATER):
        history.append_snapshot(orders, root, "recent_runs", as_of)
    return history.read_history(t.spark, root, "recent_runs", until=CUT).groupBy(
        "DB_Name", "SP_Name", F.regexp_replace("snapshot_run", "-.*", "").alias("snapshot_run")).agg(
        F.count("*").alias("n"), F.sum("last_elapsed_time").alias("total"), F.max("Date").alias("newest"))


@query
def collect_errors(t):
    """Two runs of one time, each with a failing source: stored errors, and the rows that the others stored."""
    root = scratch(t.spark, "errors")

    def fails():
        raise RuntimeError("source " + "is down " * 60)

    weekly = {"fragmentation": fails, "table_rows": lambda: r.table_rows(t)}
    for collectors in (weekly, {"jobs": fails, "page_life": fails}, weekly):
        runner.run_collect(t.spark, root, collectors, LOADED)
    errors = history.read_history(t.spark, root, "errors").select("TableName", F.length("Message").cast("long").alias("n"))
    rows = history.read_history(t.spark, root, "table_rows").select(F.lit("table_rows").alias("TableName"))
    return errors.union(rows.groupBy("TableName").agg(F.count("*").alias("n")))


@query
def parameter_lookup(t):
    """Events within the minutes that the settings name, after the default was changed; days of history come from them too."""
    blank = t.customer.select(
        F.lit("12").alias("Item"), F.col("c_name").alias("SP_Name"), F.lit("Minutes").alias("Class"), tp.ts_lit(LOADED).alias("Date"))
    seeded = parameters.seed_parameters(t.spark, blank, LOADED)
    change = seeded.filter(F.col("SP_Name") == parameters.ALERTS).filter("Class = 'Minutes'").withColumn("Item", F.lit("2880"))
    settings = parameters.change_parameters(seeded, change, LATER)
    minutes = int(parameters.parameter(settings, parameters.ALERTS, "Minutes"))
    days = parameters.retention_days(settings)
    return timewindow.recent(t.events, "ts", minutes / 1440, EVENTS_AT).select(
        "event_id", "ts", F.lit(days["index_usage"]).alias("usage_days"), F.lit(days["jobs"]).alias("job_days"))


@r.once
def _settings(t):
    """The customers of one segment as routines that alerts leave out, beside the default settings."""
    out = r.exclusions(t).select("Item", F.lit(parameters.ALERTS).alias("SP_Name"), F.lit("Exclusion").alias("Class"), tp.ts_lit(LOADED).alias("Date"))
    return parameters.seed_parameters(t.spark, out, LOADED)


def _poll(t, root, as_of, **more):
    return runner.poll_alerts(t.spark, root, r.user_procedures(t), r.user_runs(t), _settings(t), as_of, **more)


def _alert_history(t):
    root = scratch(t.spark, "alerts_run")
    history.append_snapshot(r.user_history(t), root, "routine_exec", EVENTS_AT)
    return root


@query
def rejected_rows(t):
    """Orders landed as text, the price of some no number and the key of some missing: rows read, and rows rejected into the errors table."""
    root, key = scratch(t.spark, "rejects"), F.col("o_orderkey")
    price = F.when(key % 7 == 3, F.lit("n/a")).otherwise(F.floor("o_totalprice").cast("bigint").cast("string"))
    line = F.concat_ws(",", F.when(key % 11 == 5, F.concat(F.lit("#"), key.cast("string"))).otherwise(key.cast("string")), "o_orderstatus", price)
    t.orders.select(line.alias("value")).write.text(f"{root}/orders")
    kind = StructType.fromDDL("o_orderkey BIGINT, status STRING, price BIGINT")
    good, bad = landed.read_checked(t.spark, f"{root}/orders", kind)
    history.append_snapshot(landed.rejects_as_errors(bad, "orders", LOADED), root, "errors", LOADED)
    errors = history.read_history(t.spark, root, "errors")
    return good.select("o_orderkey", "status", "price").unionByName(
        errors.select(F.expr("try_cast(regexp_extract(Message, '([0-9]+),', 1) as bigint)").alias("o_orderkey"), F.col("TableName").alias("status"),
                      F.lit(None).cast("bigint").alias("price")))


@query
def cpu_records_of_files(t):
    """Ring-buffer records of all events written as XML files and read back."""
    root = scratch(t.spark, "xml")
    parsed = r.ring_records(t).select(F.col("timestamp").alias("_timestamp"), F.from_xml("record", F.lit(collect.CPU_RECORD)).alias("x"))
    parsed.select("_timestamp", "x.*").write.format("xml").options(rootTag="Records", rowTag="Record").save(f"{root}/records")
    kind = StructType.fromDDL("_timestamp BIGINT, " + collect.CPU_RECORD)
    records = landed.read_xml(t.spark, f"{root}/records", kind, row_tag="Record")
    return collect.cpu_records(records, 200_000_000, EVENTS_AT, hours=24)


@query
def orders_by_collated_name(t):
    """Customers found by their names in other case and with trailing blanks."""
    said = t.customer.select(F.concat(F.upper("c_name"), F.expr("repeat(' ', cast(c_custkey % 3 as int))")).alias("name"), "c_nationkey")
    known = t.customer.select(F.col("c_name").alias("name"), "c_custkey").filter("c_custkey % 4 > 0")
    return joins.name_join(said, known, ["name"], "left").select(F.length("name").alias("n"), "c_nationkey", "c_custkey")


@query
def orders_if_any(t):
    """Orders counted by status if any item was returned at a discount, and those by priority if any has a negative price: only the first condition holds."""
    cheap = t.lineitem.filter("l_discount > 0.05 and l_returnflag = 'R'")
    never = t.orders.filter("o_totalprice < 0")
    by = lambda kind: t.orders.groupBy(F.col(kind).alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    return joins.only_if(by("o_orderstatus"), cheap).unionByName(joins.only_if(by("o_orderpriority"), never))


@query
def bounds_of_loads(t):
    """Bounds from the moments of three loads, one of them run again, after a part of the first has expired, with a load that has no moments."""
    root, rows = scratch(t.spark, "moments"), r.routine_exec(t)
    year = F.year("Date")
    loads = {"1994-12-31 12:00:00": year <= 1994, "1996-12-31 12:00:00": year.between(1995, 1996), "1997-12-31 12:00:00": year == 1997}
    for as_of, some in [*loads.items(), *loads.items()][:4]:
        runner.run_collect(t.spark, root, {"routine_exec": lambda some=some: rows.filter(some)}, as_of, retention_days={})
    history.append_snapshot(rows.filter((year > 1997) | year.isNull()), root, "routine_exec", "1998-12-31 12:00:00")
    return plain(moments.stored_bounds(t.spark, root, "routine_exec", "1999-01-01 12:00:00", *runner.SUMMED["routine_exec"], days=1600.5), 2)


@query
def alert_run(t):
    """A whole alert run: runs taken, routines flagged against the stored history, alerts stored and read."""
    return _poll(t, _alert_history(t), EVENTS_AT, days=30)


@query
def alert_run_again(t):
    """The run repeated so that nothing is flagged: the alerts and names it had stored are gone, its runs are there once."""
    root = _alert_history(t)
    for least in (2, 1_000_000_000):
        _poll(t, root, EVENTS_AT, days=30, min_runs=least)
    counts = [
        history.read_history(t.spark, root, table).agg(F.lit(table).alias("stored"), F.count("*").alias("n"))
        for table in ("alerts", "flagged_routines", "recent_runs")
    ]
    return counts[0].union(counts[1]).union(counts[2])


@query
def recent_runs_held(t):
    """Runs of a poll ten days ago, held for twenty days, with those of the last five days."""
    root = scratch(t.spark, "held")
    first = alerts.recent_runs(r.user_procedures(t), r.user_runs(t), "2024-01-21 00:00:00", exclusions=r.exclusions(t), days=12)
    history.append_snapshot(first, root, "recent_runs", "2024-01-21 00:00:00")
    return alerts.recent_runs(
        r.user_procedures(t), r.user_runs(t), EVENTS_AT, held=runner.held_runs(t.spark, root, EVENTS_AT), exclusions=r.exclusions(t),
        minutes=20 * 1440, days=5)


@query
def fan_in(t):
    """Row counts of the orders of each priority, landed one by one and stacked."""
    names = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    parts = {n: t.orders.filter(F.col("o_orderpriority") == n).select("o_orderkey", "o_custkey") for n in names}
    return landed.fan_in(parts)


# ---------------------------------------------------------------- streams replayed to completion

@query
def stream_volumes(t):
    return replay.volumes(t.spark, t.folder)


@query
def stream_deltas(t):
    return replay.deltas(t.spark, t.folder)


@query
def stream_alerts(t):
    return replay.alerts(t.spark, t.folder)


@query
def stream_alerts_joined(t):
    return replay.joined(t.spark, t.folder)


@query
def stream_reported_once(t):
    return replay.reported(t.spark, t.folder)


@query
def stream_history(t):
    return replay.history(t.spark, t.folder)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        name: (lambda spark, folder, fn=fn: plain(fn(Tables(spark, folder)))) for name, fn in _QUERIES.items()
    }
