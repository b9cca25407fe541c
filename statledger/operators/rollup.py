"""Grouped roll-ups: duration buckets, usage shares, distinct-value checks and command text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import pct_trunc

# Upper limits in microseconds, labels and sort order of the duration buckets.
DURATION_BUCKETS = [(1_000_000, "1 Sec", 1), (5_000_000, "5 Sec", 2), (30_000_000, "30 Sec", 3)]
DURATION_REST = ("> 30 Sec", 4)


def duration_bucket(micros: Column) -> tuple[Column, Column]:
    """Label and sort order of a mean duration; an unknown duration falls in the last bucket."""
    label, order = F.lit(DURATION_REST[0]), F.lit(DURATION_REST[1])
    for limit, text, position in reversed(DURATION_BUCKETS):
        label = F.when(micros < limit, F.lit(text)).otherwise(label)
        order = F.when(micros < limit, F.lit(position)).otherwise(order)
    return label, order


USAGE_TOTALS = ["TotalAccesses", "TotalWrites", "TotalReads", "ReadSeeks", "ReadScans"]


def usage_totals(df: DataFrame, keys: Sequence[str], seeks: str, scans: str, updates: str) -> DataFrame:
    """Accesses, writes, reads, seeks and scans per key, as bigint.

    A row with an unknown counter adds nothing to the combined totals. Stored
    totals have at most 18 digits, so bigint holds them without decimal objects.
    """
    s, c, u = (F.col(name).cast("bigint") for name in (seeks, scans, updates))
    parts = dict(zip(USAGE_TOTALS, (s + c + u, u, s + c, s, c)))
    return df.groupBy(*keys).agg(*[F.sum(x).alias(out) for out, x in parts.items()])


def with_shares(totals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Totals with read/write and seek/scan percentages, for keys with any read."""

    def total(name: str) -> Column:
        return F.col(name).cast("decimal(18,0)").alias(name)

    return totals.filter(F.col("TotalReads") > 0).select(
        *keys,
        total("TotalAccesses"),
        total("TotalWrites"),
        pct_trunc("TotalWrites", "TotalAccesses").alias("PercentAccessesAreWrites"),
        total("TotalReads"),
        pct_trunc("TotalReads", "TotalAccesses").alias("PercentAccessesAreReads"),
        total("ReadSeeks"),
        pct_trunc("ReadSeeks", "TotalReads").alias("PercentReadsAreIndexSeeks"),
        total("ReadScans"),
        pct_trunc("ReadScans", "TotalReads").alias("PercentReadsAreIndexScans"),
    )


def usage_share(df: DataFrame, keys: Sequence[str], seeks: str, scans: str, updates: str) -> DataFrame:
    """Access totals and percentages per key."""
    return with_shares(usage_totals(df, keys, seeks, scans, updates), keys)


def single_valued(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Keys that only ever showed one value (NULLs aside): minimum equals maximum, so no distinct set is built."""
    bounds = df.groupBy(*keys).agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"))
    return bounds.filter(F.col("__lo") == F.col("__hi")).select(*keys)


def joined_text(df: DataFrame, by: Sequence[str], text: str, out: str, separator: str = ";") -> DataFrame:
    """Distinct texts of each group, sorted and joined.

    Choose ``by`` so that a group is small by nature, such as one table's commands.
    """
    distinct = df.filter(F.col(text).isNotNull()).select(*by, text).distinct()
    return distinct.groupBy(*by).agg(F.array_join(F.array_sort(F.collect_list(text)), separator).alias(out))
