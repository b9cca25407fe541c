"""Maintenance worklists: what to rebuild or refresh, as command rows. Nothing is executed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import int_div
from ..functions.text import not_prefixed, optimize_command, rebuild_index_maxdop, update_statistics_quoted
from ..operators.joins import update_from
from ..operators.ordered import top_k
from ..operators.timewindow import recent
from ..sources.scratch import stored
from . import reports
from .reports import WEEK

Scope = Sequence[str]


def table_candidates(
    with_row_count: DataFrame, stale: DataFrame, fragmented: DataFrame, spacious: DataFrame, as_of, *, n: int = 100,
    scope: Scope = (),
) -> DataFrame:
    """Tables that may need work: from free space, fragmentation, stale statistics, and the top ``n`` by reads and by scans."""
    keys = [*scope, "DBName", "TableName"]
    tie = [*keys, "RowCount", "Date"]
    reads = top_k(with_row_count, n, [F.desc("TotalReads"), *tie])
    scans = top_k(with_row_count, n, [F.desc("ReadScans"), *tie])
    # distinct names alone: Catalyst then drops the outer join that only decorates the free-space rows
    loose = recent(spacious, "Date", WEEK, as_of).select(*keys).distinct()
    parts = [loose, fragmented, stale, reads, scans]
    out = parts[0].select(*keys)
    for part in parts[1:]:
        out = out.union(part.select(*keys))
    return out.distinct()


def index_candidates(index_usage: DataFrame, spacious: DataFrame, as_of, *, n: int = 50, scope: Scope = ()) -> DataFrame:
    """Indexes that may need work: the ``n`` most used and those with free space."""
    keys = [*scope, "DBName", "TableName", "IndexName"]
    loose = recent(spacious, "Date", WEEK, as_of).select(*keys).distinct()
    return busiest_indexes(index_usage, as_of, n=n, scope=scope).union(loose).distinct()


def busiest_indexes(index_usage: DataFrame, as_of, *, n: int = 50, scope: Scope = ()) -> DataFrame:
    """Names of the ``n`` most used indexes of the week."""
    keys = [*scope, "DBName", "TableName", "IndexName"]
    usage = recent(index_usage, "Date", WEEK, as_of).select(
        *scope, F.col("DB_Name").alias("DBName"), F.col("Table_Name").alias("TableName"),
        F.col("Index_Name").alias("IndexName"), "Date",
        (F.col("user_seeks") + F.col("user_scans") + F.col("user_lookups") + F.col("user_updates")).alias("__use"),
    )
    return top_k(usage, n, [F.desc("__use"), *keys, "Date"]).select(*keys)


def enrich_candidates(
    candidates: DataFrame, table_usage: DataFrame, table_rows: DataFrame, as_of, *, scope: Scope = ()
) -> DataFrame:
    """Add accesses, reads and row count of the newest snapshot of the week."""
    keys = [*scope, "DBName", "TableName"]
    renamed = {"DatabaseName": "DBName"}
    usage = recent(table_usage, "Date", WEEK, as_of).withColumnsRenamed(renamed)
    sizes = recent(table_rows, "Date", WEEK, as_of).withColumnsRenamed({**renamed, "RowCount": "RecordCount"})
    used = update_from(candidates, usage, keys, ["TotalAccesses", "TotalReads"], newest_by="Date")
    return update_from(used, sizes, keys, ["RecordCount"], newest_by="Date")


def size_cut(
    tables: DataFrame, indexes: DataFrame, max_rows: int, max_index_rows: int, *, scope: Scope = ()
) -> tuple[DataFrame, DataFrame]:
    """Split the work: whole tables below ``max_rows``, and single indexes of the other tables below ``max_index_rows``.

    Tables above ``max_rows`` leave the table list first, so their indexes return
    as index work. A table of exactly ``max_rows`` rows or of unknown size stays on
    the list, which keeps its indexes off the other one, but gets no command.
    """
    keys = [*scope, "DBName", "TableName"]
    listed = tables.filter((F.col("RecordCount") <= max_rows) | F.col("RecordCount").isNull())
    index_work = indexes.join(listed.select(*keys).distinct(), keys, "left_anti").filter(
        F.col("RecordCount") < max_index_rows
    )
    return listed.filter(F.col("RecordCount") < max_rows), index_work


def rebuild_commands(
    tables: DataFrame, indexes: DataFrame, max_rows: int, max_index_rows: int, *, online: bool = True, maxdop: int = 2,
    scope: Scope = (),
) -> DataFrame:
    """One distinct command per table and per index to rebuild (``level`` tells which)."""
    whole, single = size_cut(tables, indexes, max_rows, max_index_rows, scope=scope)
    options = {"online": online, "maxdop": maxdop}
    per_table = whole.select(
        *scope, "DBName", "TableName", F.lit("table").alias("level"),
        optimize_command("DBName", "TableName", **options).alias("Command"),
    )
    per_index = single.select(
        *scope, "DBName", "TableName", F.lit("index").alias("level"),
        optimize_command("DBName", "TableName", "IndexName", **options).alias("Command"),
    )
    return per_table.union(per_index).filter(F.col("Command").isNotNull()).distinct()


def rebuild_work(
    table_usage: DataFrame, table_rows: DataFrame, statistics: DataFrame, fragmentation: DataFrame, free_space: DataFrame,
    index_usage: DataFrame, as_of, *, n: int = 100, n_indexes: int = 50, scope: Scope = (),
) -> DataFrame:
    """All candidates in one frame: tables and indexes (``level`` tells which) with the row count of the newest snapshot of the week.

    Each history table is read once. The week's usage and row counts, and their join, are stored in the shared
    folder, as several rankings start from them.
    """
    keys = [*scope, "DBName", "TableName"]
    used = stored(recent(table_usage, "Date", WEEK, as_of), "week_of_usage")
    rows = stored(recent(table_rows, "Date", WEEK, as_of), "week_of_rows")
    sized = stored(reports.tables_with_row_count(used, rows, as_of, scope=scope), "sized_tables")
    stale = reports.stale_of(reports.with_statistics(sized, statistics, as_of, scope=scope), as_of, scope=scope)
    broken = reports.fragmented_top_tables(fragmentation, used, as_of, scope=scope)
    loose = reports.spacious_indexes(free_space, as_of).withColumnRenamed("Index_Name", "IndexName").select(*keys, "IndexName")

    def item(level: str, index) -> Column:
        return F.struct(F.lit(level).alias("level"), index.cast("string").alias("IndexName"))

    none = F.lit(None)
    tie = [*keys, "RowCount", "Date"]
    parts = [
        loose.select(*keys, item("loose", F.col("IndexName")).alias("__item")),
        *[
            part.select(*keys, item("table", none).alias("__item"))
            for part in (broken, stale, *(top_k(sized, n, [F.desc(c), *tie]) for c in ("TotalReads", "ReadScans")))
        ],
        busiest_indexes(index_usage, as_of, n=n_indexes, scope=scope).select(*keys, item("index", F.col("IndexName")).alias("__item")),
    ]
    # dealt by table once: the distinct, the join to the row counts and what follows by table need no other shuffle
    placed = reduce(DataFrame.union, parts).repartition(*keys)
    both = F.array(item("table", none), item("index", F.col("__item.IndexName")))  # free space lists the table and the index
    spread = F.explode(F.when(F.col("__item.level") == "loose", both).otherwise(F.array("__item")))
    listed = placed.distinct().select(*keys, spread.alias("__item")).select(*keys, "__item.*").distinct()
    sizes = rows.withColumnsRenamed({"DatabaseName": "DBName", "RowCount": "RecordCount"})
    return update_from(listed, sizes, keys, ["RecordCount"], newest_by="Date")


def commands_of(
    work: DataFrame, max_rows: int, max_index_rows: int, *, online: bool = True, maxdop: int = 2, scope: Scope = ()
) -> DataFrame:
    """The commands of :func:`rebuild_commands` from the candidates of :func:`rebuild_work`, without joining them to themselves.

    Those list every table and index once, and a command holds their names, so commands need not be told apart again.
    """
    keys = [*scope, "DBName", "TableName"]
    whole = F.col("level") == "table"
    stays = whole & ((F.col("RecordCount") <= max_rows) | F.col("RecordCount").isNull())
    held = F.max(F.coalesce(stays, F.lit(False))).over(Window.partitionBy(*keys))
    wanted = F.when(whole, F.col("RecordCount") < max_rows).otherwise(~F.col("__held") & (F.col("RecordCount") < max_index_rows))
    options = {"online": online, "maxdop": maxdop}
    command = F.when(whole, optimize_command("DBName", "TableName", **options)).otherwise(
        optimize_command("DBName", "TableName", "IndexName", **options)
    )
    chosen = work.withColumn("__held", held).filter(wanted)
    return chosen.select(*keys, "level", command.alias("Command")).filter(F.col("Command").isNotNull())


def modified_percent(
    table_rows: DataFrame, statistics: DataFrame, table_usage: DataFrame, as_of, *, scope: Scope = ()
) -> DataFrame:
    """Current statistics with the share of rows modified since their last update, and the commands to refresh them.

    Names starting with an underscore (automatic statistics) are left out.
    """
    keys = [*scope, "Database_Name", "Table_Name"]
    name = {"DatabaseName": "Database_Name", "TableName": "Table_Name"}
    sizes = recent(table_rows, "Date", WEEK, as_of).filter(F.col("RowCount") > 1).withColumnsRenamed(name)
    used = recent(table_usage, "Date", WEEK, as_of).withColumnsRenamed(name)
    changed = statistics.filter((F.col("rowmodctr") > 0) & not_prefixed("Index_Name")).withColumnsRenamed(
        {"DB_Name": "Database_Name"}
    )
    # Distinct on the way in: repeated snapshots with equal values would only multiply and be dropped again.
    joined = (
        changed.select(*keys, "Index_Name", "LastUpdateDate", "rowmodctr").distinct()
        .join(sizes.select(*keys, "RowCount").distinct(), keys)
        .join(used.select(*keys, "TotalAccesses", "TotalReads").distinct(), keys)
    )
    return joined.select(
        *keys, "Index_Name", "LastUpdateDate", "rowmodctr", "RowCount", "TotalAccesses", "TotalReads",
        int_div(F.col("rowmodctr").cast("bigint") * 100, F.col("RowCount")).alias("PercentModified"),
        update_statistics_quoted("Table_Name", "Index_Name").alias("RebuildState"),
        rebuild_index_maxdop("Table_Name", "Index_Name").alias("IndexRebuild"),
    )


def stats_worklist(
    modified: DataFrame, percent_modified: int, max_rows: int, min_modified: int, *, scope: Scope = ()
) -> DataFrame:
    """Refresh commands for statistics with many modified rows, by share or by number, on tables below ``max_rows``."""
    wanted = (F.col("PercentModified") > percent_modified) | (F.col("rowmodctr") > min_modified)
    return modified.filter(wanted & (F.col("RowCount") < max_rows)).select(
        *scope, "Database_Name", "Table_Name", F.col("RebuildState").alias("Command")
    ).distinct()


def refresh_commands(
    table_rows: DataFrame, statistics: DataFrame, table_usage: DataFrame, as_of, percent_modified: int, max_rows: int, min_modified: int,
    *, scope: Scope = (),
) -> DataFrame:
    """The commands of :func:`stats_worklist` over :func:`modified_percent`, without the rows that lead to them.

    The share of modified rows grows with ``rowmodctr`` and falls with the row count, as counts over 1 alone are taken. So
    the greatest ``rowmodctr`` of an index and the smallest row count of its table decide whether any of their pairs is wanted.
    """
    keys = [*scope, "Database_Name", "Table_Name"]
    name = {"DatabaseName": "Database_Name", "TableName": "Table_Name"}
    sizes = recent(table_rows, "Date", WEEK, as_of).filter(F.col("RowCount") > 1).withColumnsRenamed(name)
    used = recent(table_usage, "Date", WEEK, as_of).withColumnsRenamed(name)
    changed = statistics.filter((F.col("rowmodctr") > 0) & not_prefixed("Index_Name")).withColumnsRenamed({"DB_Name": "Database_Name"})
    placed = changed.select(*keys, "Index_Name", "rowmodctr").repartition(*keys)  # one shuffle for the groups and the join
    most = placed.groupBy(*keys, "Index_Name").agg(F.max("rowmodctr").alias("rowmodctr"))
    least = sizes.groupBy(*keys).agg(F.min("RowCount").alias("RowCount")).join(used.select(*keys), keys, "left_semi")
    percent = int_div(F.col("rowmodctr").cast("bigint") * 100, F.col("RowCount"))
    wanted = ((percent > percent_modified) | (F.col("rowmodctr") > min_modified)) & (F.col("RowCount") < max_rows)
    # an index comes once, so its command does
    return most.join(least, keys).filter(wanted).select(*keys, update_statistics_quoted("Table_Name", "Index_Name").alias("Command"))
