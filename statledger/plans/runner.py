"""Run collectors for one ``as_of``: each source on its own, failures recorded, never silent."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timeparts import parse_as_of, ts_lit
from ..operators import timewindow
from ..operators.timewindow import PARTITION, apply_retention
from ..sources.history import RUN, append_snapshot, drop_expired, read_history
from ..sources.moments import store_moments, stored_bounds
from ..sources.schemas import RETENTION_DAYS, STAMP
from . import alerts, reports, worklists
from .parameters import ALERTS, parameter

Task = Callable[[], DataFrame]
#: Tables whose bounds are asked for again and again: keys and value of the sums that are kept with each load.
SUMMED = {"routine_exec": (reports.ROUTINE_KEYS, "avg_elapsed_time")}


def error_rows(spark: SparkSession, failures: Mapping[str, str], as_of) -> DataFrame:
    """Failures in the shape of the errors table."""
    rows = spark.createDataFrame(list(failures.items()), "TableName STRING, Message STRING")
    return rows.select(ts_lit(as_of).alias("Date"), "TableName", "Message")


def run_isolated(spark: SparkSession, tasks: Mapping[str, Callable[[], None]], as_of) -> DataFrame:
    """Run every task; one that fails does not stop the others. Returns the failures as rows."""
    failures = {}
    for name, task in tasks.items():
        try:
            task()
        except Exception as error:  # recorded below for the caller to act on
            failures[name] = f"{type(error).__name__}: {error}"
    return error_rows(spark, failures, as_of)


def run_collect(
    spark: SparkSession, root: str, collectors: Mapping[str, Task], as_of, *, extra=(),
    retention_days: Mapping[str, int] = RETENTION_DAYS,
) -> DataFrame:
    """Collect each table into its history, then drop expired days. Failures of either are recorded and returned.

    ``collectors`` maps history table to a function that builds the rows to append.
    Tables without an entry in ``retention_days`` keep everything. Errors are kept by the
    set of collected tables, so two runs of one ``as_of`` keep theirs and a rerun replaces its own.
    """

    def append(table: str, build: Task) -> Callable[[], None]:
        def run() -> None:
            append_snapshot(build(), root, table, as_of, extra=extra)
            if table in SUMMED:
                store_moments(spark, root, table, as_of, *SUMMED[table], extra=extra)

        return run

    def drop(table: str) -> Callable[[], None]:
        def run() -> None:
            drop_expired(spark, root, table, retention_days[table], as_of)
            if table in SUMMED:
                drop_expired(spark, root, f"{table}_moments", retention_days[table], as_of)

        return run

    failed = run_isolated(spark, {table: append(table, build) for table, build in collectors.items()}, as_of)
    undropped = run_isolated(spark, {table: drop(table) for table in collectors if table in retention_days}, as_of)
    errors = failed.unionByName(undropped)
    names = hashlib.sha256("\n".join(sorted(collectors)).encode()).hexdigest()[:16]
    append_snapshot(errors, root, "errors", as_of, part=names)
    return errors


def history(
    spark: SparkSession, root: str, table: str, as_of, *, extra=(), retention_days: Mapping[str, int] = RETENTION_DAYS
) -> DataFrame:
    """A history table as it stood at ``as_of``, within its retention."""
    df = read_history(spark, root, table, extra=extra, until=as_of)
    days = retention_days.get(table)
    return df if days is None else apply_retention(df, days, as_of, STAMP.get(table, "Date"))


def run_alerts(
    spark: SparkSession, root: str, runs: DataFrame, as_of, *, min_runs: int = 2, n: int = 1000, extra=()
) -> DataFrame:
    """Flag repeatedly slow routines against their history and store the alert rows of this ``as_of``.

    The recent runs and the flagged names are stored as well. A rerun replaces all three, so alerts that it
    withdraws are gone; with nothing flagged there are no alert rows. Returns the stored alert rows.
    """
    append_snapshot(runs, root, "recent_runs", as_of, extra=extra)
    held = _of_run(spark, root, "recent_runs", as_of, extra)
    bounds = stored_bounds(spark, root, "routine_exec", as_of, *SUMMED["routine_exec"], days=RETENTION_DAYS["routine_exec"], extra=extra)
    offences = alerts.offences(held, bounds, min_runs=min_runs, scope=extra).persist()
    try:
        append_snapshot(offences.select(*extra, "SP_Name").distinct(), root, "flagged_routines", as_of, extra=extra)
        # with nothing flagged the details are not looked for; their folder is replaced by an empty one
        shown = alerts.shown(offences, n=n, scope=extra)
        append_snapshot(spark.createDataFrame([], shown.schema) if offences.isEmpty() else shown, root, "alerts", as_of, extra=extra)
    finally:
        offences.unpersist()
    return _of_run(spark, root, "alerts", as_of, extra)


def poll_alerts(
    spark: SparkSession, root: str, procedures: DataFrame, stats: DataFrame, settings: DataFrame, as_of, *, days=1,
    min_runs: int = 2, n: int = 1000, extra=(),
) -> DataFrame:
    """One whole alert run: take the held runs from the history, add the fresh ones, store and flag.

    The minutes that runs are held and the routines left out come from ``settings``.
    """
    minutes = int(parameter(settings, ALERTS, "Minutes", 120))
    runs = alerts.recent_runs(
        procedures, stats, as_of, held=held_runs(spark, root, as_of, extra=extra),
        exclusions=settings.filter((F.col("SP_Name") == ALERTS) & (F.col("Class") == "Exclusion")), minutes=minutes, days=days, scope=extra,
    )
    return run_alerts(spark, root, runs, as_of, min_runs=min_runs, n=n, extra=extra)


def held_runs(spark: SparkSession, root: str, as_of, *, extra=()) -> DataFrame:
    """The runs stored by the last alert run before ``as_of``."""
    stored = read_history(spark, root, "recent_runs", extra=extra)
    at = parse_as_of(as_of)
    load = F.struct(F.col(PARTITION).alias("day"), F.col(RUN).alias("run"))
    limit = F.struct(F.lit(at.date().isoformat()).cast("date").alias("day"), F.lit(at.strftime("%H%M%S")).alias("run"))
    before = stored.withColumn("__load", load).filter(F.col("__load") < limit)
    last = before.agg(F.max("__load").alias("__last"))  # one row
    return before.join(F.broadcast(last), F.col("__load") == F.col("__last")).drop("__load", "__last", PARTITION, RUN)


def _of_run(spark: SparkSession, root: str, table: str, as_of, extra) -> DataFrame:
    """The rows one run stored."""
    at = parse_as_of(as_of)
    day = F.lit(at.date().isoformat()).cast("date")
    stored = read_history(spark, root, table, extra=extra)
    return stored.filter((F.col(PARTITION) == day) & (F.col(RUN) == at.strftime("%H%M%S"))).drop(PARTITION, RUN)


def run_recommend(
    spark: SparkSession, root: str, as_of, *, max_rows: int = 1_700_000, max_index_rows: int = 3_000_000,
    percent_modified: int = 2, stats_max_rows: int = 45_000_000, min_modified: int = 90_000, online: bool = True,
    maxdop: int = 2, extra=(),
) -> tuple[DataFrame, DataFrame]:
    """Rebuild commands and statistics commands from the stored history. Nothing is executed."""

    def stored(table: str) -> DataFrame:
        return history(spark, root, table, as_of, extra=extra)

    used, rows, stats = stored("table_usage"), stored("table_rows"), stored("statistics")
    work = worklists.rebuild_work(
        used, rows, stats, stored("fragmentation"), stored("index_free_space"), stored("index_usage"), as_of, scope=extra
    )
    rebuilds = worklists.commands_of(work, max_rows, max_index_rows, online=online, maxdop=maxdop, scope=extra)
    current = timewindow.recent(stats, "Date", reports.WEEK, as_of)
    return rebuilds, worklists.refresh_commands(rows, current, used, as_of, percent_modified, stats_max_rows, min_modified, scope=extra)
