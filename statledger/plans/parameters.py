"""Configuration rows (item, procedure, class) and their defaults."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timeparts import ts_lit
from ..operators.joins import seed_missing, upsert
from ..sources.schemas import RETENTION_DAYS

# Default settings.
DEFAULTS = [
    ("180", "bp_io_performance", "Days"),
    ("120", "bp_long_run_SP", "Minutes"),
    ("bp_long_run_SP", "bp_long_run_SP", "Exclusion"),
    ("180", "bp_index_frag_history", "Days"),
]
KEY = ["SP_Name", "Class"]
ALERTS, IO, WEEKLY = "bp_long_run_SP", "bp_io_performance", "bp_index_frag_history"
#: Tables whose days of history the weekly setting gives; index usage is kept ``LONGER`` by so many days.
WEEKLY_TABLES = (
    "fragmentation", "statistics", "table_usage", "routine_catalog", "routine_exec", "top_queries", "index_free_space", "table_rows",
    "index_usage",
)
LONGER = {"index_usage": 185}


def seed_parameters(spark: SparkSession, current: DataFrame, as_of) -> DataFrame:
    """Add the defaults whose procedure and class are not configured yet."""
    seeds = spark.createDataFrame(DEFAULTS, "Item STRING, SP_Name STRING, Class STRING").withColumn("Date", ts_lit(as_of))
    return seed_missing(current, seeds, KEY)


def change_parameters(current: DataFrame, changes: DataFrame, as_of) -> DataFrame:
    """Apply changed settings and stamp them."""
    return upsert(current, changes, KEY, "Date", ts_lit(as_of))


def parameter(params: DataFrame, procedure: str, cls: str, default=None):
    """The one value of a setting; ``default`` when absent, an error when ambiguous."""
    rows = params.filter((F.col("SP_Name") == procedure) & (F.col("Class") == cls)).select("Item").limit(2).collect()
    if len(rows) > 1:
        raise ValueError(f"several values for {procedure}/{cls}")
    return rows[0]["Item"] if rows else default


def retention_days(params: DataFrame, defaults: Mapping[str, int] = RETENTION_DAYS) -> dict[str, int]:
    """Days of history of each table, from the settings; tables without a setting keep their default."""
    weekly, io = parameter(params, WEEKLY, "Days"), parameter(params, IO, "Days")
    found = dict(defaults)
    if weekly is not None:
        found |= {table: int(weekly) + LONGER.get(table, 0) for table in WEEKLY_TABLES}
    if io is not None:
        found["file_io"] = int(io)
    return found
