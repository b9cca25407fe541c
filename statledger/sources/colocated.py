"""History tables laid out for joins by table: bucketed by (database, table), so that reports join them without a shuffle.

``append_snapshot`` lays history out by load, which suits retention and time windows. Where the same reports run day after
day, a copy bucketed by the join keys moves the shuffle from each report to the one write. All tables to be joined need
the same number of buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..operators.timewindow import PARTITION

BUCKETS = 200
LEAST_BUCKETS, BUCKET_ROWS = 8, 500_000
TABLE_KEYS = {
    "table_usage": ("DatabaseName", "TableName"),
    "table_rows": ("DatabaseName", "TableName"),
    "statistics": ("DB_Name", "Table_Name"),
    "index_usage": ("DB_Name", "Table_Name"),
    "index_free_space": ("DB_Name", "Table_Name"),
    "fragmentation": ("DB_Name", "Table_Name"),
}


def keys_of(table: str, extra: Sequence[str] = ()) -> list[str]:
    """Bucket columns of a history table; fleet columns (``extra``) come first, as in the keys of the reports."""
    return [*extra, *TABLE_KEYS[table]]


def buckets_for(*tables: DataFrame) -> int:
    """A number of buckets for tables that are joined to each other: the largest has about ``BUCKET_ROWS`` rows in each.

    A join over buckets has one task a bucket and can't be split any further, so with a fixed number its tasks grow with the tables.
    """
    return max(LEAST_BUCKETS, *(-(-table.count() // BUCKET_ROWS) for table in tables))


def co_locate(
    df: DataFrame, name: str, keys: Sequence[str], path: str, *, buckets: int = BUCKETS, by_day: bool = True
) -> DataFrame:
    """Write the rows to ``path`` as the table ``name``, bucketed and sorted by ``keys``, and read it back.

    Rows are dealt by the bucket hash first, so each bucket is one sorted file and a join needs no sort either. With
    ``by_day``, rows that have a snapshot day keep it as partition; each day then has a file per bucket, which a join has to sort.
    """
    dealt = df.repartition(buckets, *keys).write.mode("overwrite").option("path", path).option("compression", "zstd")
    if by_day and PARTITION in df.columns:
        dealt = dealt.partitionBy(PARTITION)
    dealt.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return df.sparkSession.table(name)
