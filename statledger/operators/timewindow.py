"""Rolling time filters and retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timeparts import days_before, parse_as_of, ts_lit

PARTITION = "snapshot_date"


def recent(df: DataFrame, ts: str, days, as_of, *, inclusive: bool = False, partition: str = PARTITION) -> DataFrame:
    """Rows stamped in the ``days`` before ``as_of`` (fractions allowed; rows after ``as_of`` are left out).

    History tables are partitioned by ``snapshot_date``; when that column is
    present the same window is also put on it, so whole partitions are skipped.
    """
    cutoff = days_before(as_of, days)
    lower = F.col(ts) >= ts_lit(cutoff) if inclusive else F.col(ts) > ts_lit(cutoff)
    keep = lower & (F.col(ts) <= ts_lit(as_of))
    if partition in df.columns:
        lo, hi = F.lit(cutoff.date().isoformat()), F.lit(parse_as_of(as_of).date().isoformat())
        keep = keep & F.col(partition).between(lo.cast("date"), hi.cast("date"))
    return df.filter(keep)


def until(df: DataFrame, ts: str, as_of) -> DataFrame:
    """History as it stood at ``as_of``; rows without a date belong to it."""
    return df.filter((F.col(ts) <= ts_lit(as_of)) | F.col(ts).isNull())


def apply_retention(df: DataFrame, days, as_of, ts: str = "Date") -> DataFrame:
    """Drop rows older than ``days``. Rows without a date are kept."""
    return df.filter((F.col(ts) >= ts_lit(days_before(as_of, days))) | F.col(ts).isNull())


def drop_where(df: DataFrame, condition: Column) -> DataFrame:
    """Delete the rows for which ``condition`` is true; unknown counts as not true."""
    return df.filter(F.coalesce(~condition, F.lit(True)))
