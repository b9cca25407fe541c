"""Long-running routine alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.bounds import outliers
from ..operators.ordered import HOT_ROWS, top_k
from ..operators.timewindow import apply_retention, recent

Scope = Sequence[str]
MIN_MICROS = 1_000
RUN_KEYS = ["DB_Name", "SP_Name"]


def recent_runs(
    procedures: DataFrame, stats: DataFrame, as_of, *, held: DataFrame | None = None,
    exclusions: DataFrame | None = None, minutes: int = 120, days=1, first_user_database: int = 5, scope: Scope = (),
) -> DataFrame:
    """Last runs of the procedures of all user databases within ``days``, added to those still ``held``.

    Held runs older than ``minutes`` leave. Any number of names in ``exclusions``
    (column ``Item``) is removed after the new runs are in. A run reported by two
    polls is kept once.
    """
    keys = [*scope, "DB_Name", "object_id"]
    names = procedures.select(*keys, F.col("name").alias("SP_Name"))
    user = stats.filter(F.col("database_id") >= first_user_database)
    fresh = recent(user, "last_execution_time", days, as_of, inclusive=True).join(names, keys).select(
        *scope, *RUN_KEYS, "last_elapsed_time", F.col("last_execution_time").alias("Date")
    )
    runs = fresh if held is None else apply_retention(held, minutes / 1440, as_of).unionByName(fresh)
    if exclusions is not None:
        runs = runs.join(exclusions.select(F.col("Item").alias("SP_Name")).distinct(), "SP_Name", "left_anti")
    return runs.select(*scope, *RUN_KEYS, "last_elapsed_time", "Date").distinct()


def long_runs(runs: DataFrame, bounds: DataFrame, *, scope: Scope = (), hot_rows: int = HOT_ROWS) -> DataFrame:
    """Distinct runs over one millisecond and above the upper bound of their routine."""
    keys = [*scope, *RUN_KEYS]
    limits = bounds.withColumnRenamed("SP Name", "SP_Name")
    slow = runs.select(*keys, "last_elapsed_time", "Date").filter(F.col("last_elapsed_time") > MIN_MICROS).distinct()
    return outliers(slow, limits, keys, "last_elapsed_time", upper_only=True, hot_rows=hot_rows)


def repeat_offenders(
    runs: DataFrame, bounds: DataFrame, *, min_runs: int = 2, scope: Scope = (), hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Names of the routines with at least ``min_runs`` long runs, whatever the database."""
    found = long_runs(runs, bounds, scope=scope, hot_rows=hot_rows)
    counted = found.groupBy(*scope, "SP_Name").agg(F.count("SP_Name").alias("__runs"))
    return counted.filter(F.col("__runs") >= min_runs).select(*scope, "SP_Name")


def offences(
    runs: DataFrame, bounds: DataFrame, *, min_runs: int = 2, scope: Scope = (), hot_rows: int = HOT_ROWS
) -> DataFrame:
    """The long runs of all routines that have at least ``min_runs`` of them, in one pass over runs and bounds."""
    found = long_runs(runs, bounds, scope=scope, hot_rows=hot_rows)
    of_name = Window.partitionBy(*scope, "SP_Name")
    return found.withColumn("__runs", F.count("SP_Name").over(of_name)).filter(F.col("__runs") >= min_runs).drop("__runs")


def shown(found: DataFrame, *, n: int = 1000, scope: Scope = ()) -> DataFrame:
    """Long runs as alert rows, by name and newest first, at most ``n``."""
    rows = found.select(
        *scope, F.concat(F.trim("DB_Name"), F.lit("."), F.trim("SP_Name")).alias("SPName"), "last_elapsed_time",
        "Mean", F.col("UpperBound").cast("bigint").alias("UpprBnd"), "Date",
    )
    return top_k(rows.distinct(), n, [*scope, "SPName", F.desc("Date"), "last_elapsed_time", "Mean", "UpprBnd"])


def alert_detail(
    runs: DataFrame, bounds: DataFrame, flagged: DataFrame, *, n: int = 1000, scope: Scope = (),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The long runs of the flagged routines, by name and newest first, at most ``n``."""
    found = long_runs(runs, bounds, scope=scope, hot_rows=hot_rows)
    return shown(found.join(flagged.select(*scope, "SP_Name").distinct(), [*scope, "SP_Name"], "left_semi"), n=n, scope=scope)
