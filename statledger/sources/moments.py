"""Moments of a history table, kept load by load beside it, so that bounds need not read the whole history again.

The table ``<name>_moments`` has the folders of its history: a load that is run again replaces its moments, and days that expire take theirs
with them. Rows are summed by the day of their stamp.
"""

from __future__ import annotations

import posixpath
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.timeparts import days_before, parse_as_of
from ..operators import bounds
from ..operators.timewindow import PARTITION, apply_retention
from .history import RUN, read_history, read_parts, run_name, table_path
from .schemas import STAMP, schema

DAY = "StampDay"


def moments_path(root: str, table: str) -> str:
    return table_path(root, f"{table}_moments")


def store_moments(spark: SparkSession, root: str, table: str, as_of, keys: Sequence[str], value: str, *, extra=(), part: str = "") -> None:
    """Sum the rows of one load of a history table and keep the sums under the load's own folder name."""
    at, run = parse_as_of(as_of), run_name(as_of, part)
    day = F.lit(at.date().isoformat()).cast("date")
    rows = read_history(spark, root, table, extra=extra).filter((F.col(PARTITION) == day) & (F.col(RUN) == run))
    sums = bounds.moments(rows.withColumn(DAY, F.to_date(STAMP.get(table, "Date"))), [*extra, *keys, DAY], value)
    folder = f"{PARTITION}={at.date().isoformat()}/{RUN}={run}"
    sums.write.mode("overwrite").option("compression", "zstd").parquet(posixpath.join(moments_path(root, table), folder))


def read_moments(spark: SparkSession, root: str, table: str, keys: Sequence[str], *, extra=(), until=None) -> DataFrame:
    """The moments of all loads, or of those up to ``until``."""
    fields = {f.name: f for f in schema(table)}
    own = StructType([StructField(c, StringType()) for c in extra] + [fields[k] for k in keys if k not in extra])
    sums = StructType.fromDDL(f"{DAY} DATE, Rows BIGINT, Values BIGINT, Total DECIMAL(38,0), Squares DECIMAL(38,0)")
    return read_parts(spark, moments_path(root, table), StructType(own.fields + sums.fields), until=until)


def stored_bounds(
    spark: SparkSession, root: str, table: str, as_of, keys: Sequence[str], value: str, *, days=None, extra=(), sigmas: float = 3
) -> DataFrame:
    """Bounds over a history table as it stood at ``as_of``, within ``days``, from its moments.

    Only rows that the sums can't decide are read: those of the day on which the retention limit falls, streamed rows, and loads without moments.
    """
    every = [*extra, *keys]
    kept = read_moments(spark, root, table, keys, extra=extra, until=as_of)
    load = F.concat_ws("/", F.col(PARTITION).cast("string"), RUN)
    loads = [r[0] for r in kept.select(load).distinct().collect()]  # one name a load
    rows = read_history(spark, root, table, extra=extra, until=as_of)
    unknown = ~load.isin(loads) if loads else F.lit(True)
    if days is not None:
        stamp = STAMP.get(table, "Date")
        limit = F.lit(days_before(as_of, days).date().isoformat()).cast("date")
        kept = kept.filter(F.col(DAY).isNull() | (F.col(DAY) > limit))
        edge = F.to_date(stamp) == limit
        rows = apply_retention(rows.filter(unknown | edge), days, as_of, stamp)
    else:
        rows = rows.filter(unknown)
    sums = bounds.merged_moments([kept, bounds.moments(rows, every, value)], every)
    return bounds.bounds_of_moments(sums, every, sigmas=sigmas)
