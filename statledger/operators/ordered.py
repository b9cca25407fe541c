"""Ordered operators: previous row per key, top-k and top-k per key.

``with_previous`` is the one operator here that needs every row of a key in
time order. A key that holds a large share of the table would put that share in
one task, so rows of such keys are dealt by ranges of key, time and tie columns,
and only the last row of each range crosses to the next one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import stored

HOT_ROWS = 5_000_000
RANGES = 8  # of so many rows as make a key hot
RANGE_ROWS = 50_000  # a range holds at least about so many: with fewer, starting its task and its file take longer than its rows


def same_keys(left: str, right: str, keys: Sequence[str]) -> Column:
    """Null-safe equality of ``keys`` between two aliased frames."""
    return reduce(lambda a, b: a & b, (F.col(f"{left}.`{k}`").eqNullSafe(F.col(f"{right}.`{k}`")) for k in keys))


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int, *aggs: Column) -> DataFrame:
    """Keys with more than ``hot_rows`` rows: at most ``rows / hot_rows`` of them, so safe to broadcast."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), *aggs).filter(F.col("__n") > hot_rows)


def deal_by_range(rows: DataFrame, keys: Sequence[str], order: Sequence[str], ranges: int) -> DataFrame:
    """The rows with the number ``__range`` of their range of (keys, order): about equally many in each, whatever the spread.

    One range shuffle on Spark's own sample. Equal rows are told apart by a running number, so they are parted as well. The result lies in
    the shared folder: whatever is derived from it sees the same ranges, also when a task runs again.
    """
    tied = rows.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(ranges, *keys, *order, "__tie")
    return stored(tied.withColumn("__range", F.spark_partition_id()).drop("__tie"), "ranges")


def ranges_of(rows: int, hot_rows: int) -> int:
    """Number of ranges for the rows of hot keys: about ``hot_rows / 8`` rows in each, or ``RANGE_ROWS`` where that is more, so it grows no faster than the rows."""
    return max(2, -(-rows // max(hot_rows // RANGES, RANGE_ROWS)))


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    previous: Mapping[str, str],
    *,
    is_last: str | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Add, per row, values of the preceding row of the same key.

    ``order`` names the ordering columns, a ``timestamp_ntz`` first; together with
    the carried columns they must order the rows of a key totally, or leave only
    interchangeable rows tied. ``previous`` maps new column name to source column.
    ``is_last`` names a boolean that is true on the newest row of each key.

    Rows of keys with more than ``hot_rows`` rows are dealt by range, about ``hot_rows / 8`` in each but not under ``RANGE_ROWS``, so
    bursts, rows of one second and undated rows are parted as well. Keys are counted first, which is one aggregation over the key
    columns; without such keys a single window remains. ``hot_rows=None`` skips the count.
    """
    keys, order = list(keys), list(order)
    sources = list(dict.fromkeys(previous.values()))
    sort_cols = order + [c for c in sources if c not in order]
    row = F.struct(*[F.col(c) for c in sort_cols])

    def plain(rows: DataFrame) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(*sort_cols)
        out = rows.withColumn("__prev", F.lag(row).over(w))
        return out.withColumn(is_last, F.lead(F.lit(1)).over(w).isNull()) if is_last else out

    def ranged(rows: DataFrame) -> DataFrame:
        tails = rows.groupBy(*keys, "__range").agg(F.max(row).alias("__tail"))  # one row for each range and key
        across = Window.partitionBy(*keys).orderBy("__range")
        tails = tails.select(
            *keys,
            "__range",
            F.lag("__tail").over(across).alias("__carry"),
            F.lead("__range").over(across).isNotNull().alias("__more"),
        )
        heads = tails.filter(F.col("__carry").isNotNull()).select(
            *keys, "__range", F.lit(0).alias("__rank"), F.col("__carry")
        )
        body = rows.withColumn("__rank", F.lit(1)).unionByName(heads, allowMissingColumns=True)
        if is_last:
            ends = tails.filter("__more").select(*keys, "__range", F.lit(2).alias("__rank"))
            body = body.unionByName(ends, allowMissingColumns=True)
        w = Window.partitionBy(*keys, "__range").orderBy("__rank", *sort_cols)
        mine = F.when(F.col("__rank") == 1, row).otherwise(F.col("__carry"))
        out = body.withColumn("__prev", F.lag(mine).over(w))
        if is_last:
            out = out.withColumn(is_last, F.lead(F.lit(1)).over(w).isNull())
        return out.filter(F.col("__rank") == 1).drop("__rank", "__carry", "__range")

    hot = None if hot_rows is None else hot_keys(df, keys, hot_rows)
    many = hot.agg(F.sum("__n")).first()[0] if hot is not None else None
    if many:
        hot = F.broadcast(stored(hot.select(*keys), "hot_keys").alias("h"))
        mine = df.alias("d").join(hot, same_keys("d", "h", keys), "left_semi")
        others = df.alias("d").join(hot, same_keys("d", "h", keys), "left_anti")
        dealt = deal_by_range(mine, keys, sort_cols, ranges_of(many, hot_rows))
        out = plain(others).unionByName(ranged(dealt))
    else:
        out = plain(df)

    extra = [F.col(f"__prev.{src}").alias(new) for new, src in previous.items()]
    last = [F.col(is_last)] if is_last else []
    return out.select(*[F.col(c) for c in df.columns], *extra, *last)


def top_k(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """The first ``n`` rows in ``order``: each task keeps ``n`` rows, then they are merged."""
    return df.orderBy(*order).limit(n)


def top_k_per(df: DataFrame, keys: Sequence[str], n: int, order: Sequence[Column]) -> DataFrame:
    """The first ``n`` rows of each key; tasks cut to ``n`` rows per key before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n).drop("__rn")


def latest_per(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """The newest row of each key (ties resolved by the other columns), by partial aggregation."""
    rest = [c for c in df.columns if c not in keys and c != ts]
    newest = F.max(F.struct(F.col(ts), *[F.col(c) for c in rest])).alias("__r")
    out = df.groupBy(*keys).agg(newest)
    return out.select(*[F.col(c) if c in keys else F.col("__r").getField(c).alias(c) for c in df.columns])
