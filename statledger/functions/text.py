"""Text helpers: identifiers, maintenance commands and statement slices.

Concatenation is NULL-propagating throughout: a command with a missing name is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import _col, int_div


def quotename(x) -> Column:
    """Bracket an identifier, doubling any closing bracket."""
    return F.concat(F.lit("["), F.replace(_col(x), F.lit("]"), F.lit("]]")), F.lit("]"))


def clean_text(x) -> Column:
    """Remove line feeds, carriage returns and tabs from blank-trimmed text."""
    return F.translate(F.trim(_col(x)), "\n\r\t", "")


def message_tail(message, length: int = 45) -> Column:
    """The text that starts two characters after the first full stop."""
    m = _col(message)
    return F.substring(m, F.instr(m, ".") + 2, F.lit(length))


def statement_slice(text, start_offset, end_offset, *, as_written: bool = True) -> Column:
    """One statement of a batch, from byte offsets in two-byte characters; -1 means to the end.

    As existing readers know it, the slice starts at character ``start / 2``, where a start below one uses up
    length before the first character; it therefore begins one character early and ends one early.
    ``as_written=False`` gives the statement itself, from the character at the offset to the one at the end.
    """
    text, start, end = _col(text), _col(start_offset), _col(end_offset)
    stop = F.when(end == -1, F.length(F.rtrim(text)) * 2).otherwise(end)
    first = int_div(start, 2).cast("int")
    length = int_div(stop - start, 2).cast("int")
    if not as_written:
        return F.substring(text, first + 1, F.greatest(length, F.lit(0)) + F.when(end == -1, 0).otherwise(1))
    visible = F.greatest(length + F.least(first - 1, F.lit(0)), F.lit(0))
    return F.substring(text, F.greatest(first, F.lit(1)), visible)


def not_prefixed(name, prefix: str = "_") -> Column:
    """True when the first character differs from ``prefix``; NULL names give NULL (dropped by filters)."""
    return F.substring(_col(name), 1, 1) != prefix


# The command texts below are those that the database server and the maintenance procedure expect.


def update_statistics_command(table, index) -> Column:
    return F.concat(F.lit("UPDATE STATISTICS "), _col(table), F.lit("("), _col(index), F.lit(") WITH FULLscan"))


def update_statistics_quoted(table, index) -> Column:
    return F.concat(F.lit("UPDATE STATISTICS ["), _col(table), F.lit("]("), _col(index), F.lit(") WITH FULLSCAN"))


def rebuild_index_command(table, index) -> Column:
    return F.concat(
        F.lit("ALTER INDEX ["), _col(index), F.lit("] ON [dbo].["), _col(table), F.lit("] REBUILD with (ONLINE = ON)")
    )


def rebuild_index_maxdop(table, index, maxdop: int = 8) -> Column:
    return F.concat(
        F.lit("ALTER INDEX ["), _col(index), F.lit("] ON ["), _col(table),
        F.lit(f"] REBUILD with (ONLINE = ON,maxdop={maxdop})"),
    )


def optimize_command(database, table, index=None, *, online: bool = True, maxdop: int = 2) -> Column:
    """Index-maintenance call for a whole table, or for one index when ``index`` is given."""
    mode = "ONLINE" if online else "OFFLINE"
    target = [_col(database), F.lit(".dbo."), _col(table)]
    if index is not None:
        target += [F.lit(".["), _col(index), F.lit("]")]
    statistics = "" if index is not None else "@UpdateStatistics = 'ALL', @OnlyModifiedStatistics = 'Y', "
    actions = f"INDEX_REBUILD_{mode},INDEX_REORGANIZE"
    return F.concat(
        F.lit("EXECUTE [master].[dbo].[IndexOptimize] @Databases = ["), _col(database), F.lit("], @Indexes = '"),
        *target,
        F.lit(
            f"',@PageCountLevel=8,@TimeLimit = 900, @MaxDOP = '{maxdop}',"
            f"@FragmentationMedium = '{actions}', @FragmentationHigh = '{actions}',"
        ),
        F.lit(f"{statistics}@LogToTable = 'Y'" if statistics else " @LogToTable = 'Y'"),
    )
