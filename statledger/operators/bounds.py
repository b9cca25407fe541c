"""Three-sigma bounds and the rows that fall outside them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import int_avg
from .joins import lookup_join
from .ordered import HOT_ROWS

BOUND_COLUMNS = ["Mean", "StandardDev", "LowerBound", "UpperBound", "SampleSize"]


def sigma_bounds(df: DataFrame, keys: Sequence[str], value: str, *, sigmas: float = 3, min_rows: int = 2) -> DataFrame:
    """Mean, population deviation and mean +/- ``sigmas`` deviations per key.

    The mean is the truncated integer mean, so the bounds sit up to one unit low.
    ``SampleSize`` counts all rows, also those with a NULL value.
    """
    grouped = df.groupBy(*keys).agg(
        int_avg(value).alias("Mean"),
        F.stddev_pop(value).alias("StandardDev"),
        F.count(F.lit(1)).alias("SampleSize"),
    )
    return grouped.filter(F.col("SampleSize") >= min_rows).select(
        *keys,
        "Mean",
        "StandardDev",
        (F.col("Mean") - sigmas * F.col("StandardDev")).alias("LowerBound"),
        (F.col("Mean") + sigmas * F.col("StandardDev")).alias("UpperBound"),
        "SampleSize",
    )


def outliers(
    facts: DataFrame, bounds: DataFrame, keys: Sequence[str], value: str, *, upper_only: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Facts whose value lies outside the bounds of their key.

    The bounds normally cover the tested rows as well. Keys with NULL parts never match.
    """
    joined = lookup_join(facts, bounds, keys, weight="SampleSize", hot_rows=hot_rows)
    above = F.col(value) > F.col("UpperBound")
    if upper_only:
        return joined.filter(above)
    return joined.filter(~F.col(value).between(F.col("LowerBound"), F.col("UpperBound")))


def outlier_summary(found: DataFrame, keys: Sequence[str], value: str, day: str, mean_name: str,
                    by: Sequence[str] = ()) -> DataFrame:
    """Count, truncated mean and newest day of the outliers of each key.

    The bounds are functions of the key, so they are carried and not grouped by.
    """
    return found.groupBy(*keys, *by).agg(
        F.count(F.lit(1)).alias("Counts"),
        int_avg(value).alias(mean_name),
        *[F.max(c).alias(c) for c in BOUND_COLUMNS],
        F.max(day).alias("MostRecentDateOnly"),
    )


# ---------------------------------------------------------------- bounds from sums that are kept

MOMENTS = ["Rows", "Values", "Total", "Squares"]


def moments(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Number of rows and of values, exact sum and exact sum of squares of a whole-number column per key.

    They can be added up over any parts of a table, and those of a part that goes can be taken away again.
    """
    whole = F.col(value).cast("decimal(19,0)")
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("Rows"), F.count(value).alias("Values"), F.sum(whole).cast("decimal(38,0)").alias("Total"),
        F.sum((whole * whole).cast("decimal(38,0)")).cast("decimal(38,0)").alias("Squares"),
    )


def merged_moments(parts: Sequence[DataFrame], keys: Sequence[str], gone: Sequence[DataFrame] = ()) -> DataFrame:
    """Moments of all parts together without those that are gone; keys that have no rows left are left out."""
    signed = [p.select(*keys, *MOMENTS) for p in parts] + [g.select(*keys, *[(-F.col(c)).alias(c) for c in MOMENTS]) for g in gone]
    sums = [F.sum(c).cast("bigint" if c in ("Rows", "Values") else "decimal(38,0)").alias(c) for c in MOMENTS]
    return reduce(DataFrame.unionByName, signed).groupBy(*keys).agg(*sums).filter(F.col("Rows") > 0)


def bounds_of_moments(sums: DataFrame, keys: Sequence[str], *, sigmas: float = 3, min_rows: int = 2) -> DataFrame:
    """The bounds of ``sigma_bounds`` from moments.

    Squares are taken around the truncated mean in whole numbers first, so nothing cancels out in floating point.
    """
    mean = F.when(F.col("Values") > 0, F.call_function("div", F.col("Total"), F.col("Values").cast("decimal(19,0)")))
    known = sums.filter(F.col("Rows") >= min_rows).withColumn("Mean", mean)
    m, n = F.col("Mean").cast("decimal(19,0)"), F.col("Values").cast("decimal(19,0)")
    total = F.coalesce(F.col("Total"), F.lit(0).cast("decimal(38,0)"))
    around = F.col("Squares") - (2 * m * total).cast("decimal(38,0)") + (m * m * n).cast("decimal(38,0)")
    shift = (total - (m * n).cast("decimal(38,0)")).cast("double") / F.col("Values")
    spread = F.sqrt(F.greatest(around.cast("double") / F.col("Values") - shift * shift, F.lit(0.0)))
    return known.withColumn("StandardDev", F.when(F.col("Values") > 0, spread)).select(
        *keys,
        "Mean",
        "StandardDev",
        (F.col("Mean") - sigmas * F.col("StandardDev")).alias("LowerBound"),
        (F.col("Mean") + sigmas * F.col("StandardDev")).alias("UpperBound"),
        F.col("Rows").alias("SampleSize"),
    )
