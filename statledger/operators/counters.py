"""Cumulative counters: differences that survive restarts, rates, pivots and ratios."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import int_div, ratio3
from ..functions.timeparts import boundary_diff
from .ordered import HOT_ROWS, latest_per, with_previous


def counter_delta(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    columns: Sequence[str],
    *,
    epoch: str | None = None,
    on_reset: str = "cumulative",
    first: str = "cumulative",
    tie: Sequence[str] = (),
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Turn cumulative counters into increments, one per sample.

    A sample continues the one before it when both belong to the same ``epoch``
    (restart time); without an epoch column every sample continues its
    predecessor. Adds ``<column>_delta``, ``interval_start`` and ``seconds``.

    * ``on_reset``: what a falling counter counts as. ``cumulative`` takes the new
      value (everything since the restart), ``previous`` the value before the fall
      with zero seconds, ``zero`` nothing.
    * ``first``: what the first sample of a key or epoch counts as, ``cumulative``
      or ``zero`` (then with zero seconds).
    """
    if on_reset not in ("cumulative", "previous", "zero") or first not in ("cumulative", "zero"):
        raise ValueError(f"unknown policy: on_reset={on_reset!r}, first={first!r}")
    carried = {f"__p_{c}": c for c in columns} | {"__p_ts": ts}
    if epoch:
        carried["__p_epoch"] = epoch
    lagged = with_previous(df, keys, [ts, *tie], carried, hot_rows=hot_rows)
    continues = F.col("__p_ts").isNotNull()
    if epoch:
        continues = continues & F.col("__p_epoch").eqNullSafe(F.col(epoch))

    def delta(c: str) -> Column:
        step = F.col(c) - F.col(f"__p_{c}")
        fallen = {"cumulative": F.col(c), "previous": F.col(f"__p_{c}"), "zero": F.lit(0)}[on_reset]
        start = F.col(c) if first == "cumulative" else F.lit(0)
        return F.when(~continues, start).when(step < 0, fallen).otherwise(step).cast("bigint").alias(f"{c}_delta")

    no_history = F.lit(0).cast("bigint") if first == "zero" else F.lit(None).cast("bigint")
    start = F.when(continues, F.col("__p_ts"))
    if epoch:
        start = F.coalesce(start, F.col(epoch))
    seconds = boundary_diff("second", start, F.col(ts))
    if on_reset == "previous":
        fell = F.lit(False)
        for c in columns:
            fell = fell | (F.col(c) < F.col(f"__p_{c}"))
        seconds = F.when(continues & fell, F.lit(0)).otherwise(seconds)
    if first == "zero":
        seconds = F.when(~continues, F.lit(0)).otherwise(seconds)
    return lagged.select(
        *[F.col(c) for c in df.columns],
        *[delta(c) for c in columns],
        start.alias("interval_start"),
        F.coalesce(seconds, no_history).alias("seconds"),
    )


def counter_step(
    batch: DataFrame, last: DataFrame | None, keys: Sequence[str], ts: str, columns: Sequence[str], *,
    epoch: str | None = None, on_reset: str = "cumulative", first: str = "cumulative",
    hot_rows: int | None = HOT_ROWS, keep: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> tuple[DataFrame, DataFrame]:
    """Increments of one batch and the next last-sample table.

    ``keep`` is given the frames that are read several times and returns what to read instead, such as a persisted frame.

    A sample that is not newer than the last one of its key came too late: it is
    reported with ``late`` true and no increments, and leaves the state alone.
    """
    keys = list(keys)
    kept = [*keys, ts, *columns, *([epoch] if epoch else [])]
    samples = batch.select(*kept)
    if last is None:
        pool, tardy = samples.withColumn("__fresh", F.lit(True)), samples.limit(0)
    else:
        last = keep(last.select(*kept))
        seen = last.select(*keys, F.col(ts).alias("__last"))
        checked = keep(samples.join(seen, keys, "left").select(
            *kept, F.coalesce(F.col(ts) <= F.col("__last"), F.lit(False)).alias("__late")
        ))
        tardy = checked.filter("__late").select(*kept)
        fresh = checked.filter("NOT __late").select(*kept).withColumn("__fresh", F.lit(True))
        pool = fresh.unionByName(last.select(*kept).withColumn("__fresh", F.lit(False)))
    deltas = counter_delta(
        pool, keys, ts, columns, epoch=epoch, on_reset=on_reset, first=first, tie=["__fresh"], hot_rows=hot_rows
    )
    done = deltas.filter("__fresh").drop("__fresh").withColumn("late", F.lit(False))
    out = done.unionByName(tardy.withColumn("late", F.lit(True)), allowMissingColumns=True)
    return out, latest_per(pool.drop("__fresh"), keys, ts)


def per_minute(count, seconds) -> Column:
    """``(count * 100) div ((seconds * 100) div 60)``: per-minute rate in integer steps.

    The scaling by 100 keeps intervals under a minute from dividing by zero.
    """
    return int_div(count * 100, int_div(seconds * 100, 60))


def pivot_counters(df: DataFrame, keys: Sequence[str], name: str, value: str, wanted: Mapping[str, Column]) -> DataFrame:
    """One wide row per key from name/value rows, in a single pass without a join.

    ``wanted`` maps output column to the predicate that selects its rows. Absent
    and negative values become 0, as each metric starts from 0 and takes the maximum.
    """
    metric = [
        F.greatest(F.coalesce(F.max(F.when(pred, F.col(value))), F.lit(0)), F.lit(0)).cast("bigint").alias(out)
        for out, pred in wanted.items()
    ]
    return df.groupBy(*keys).agg(*metric)


def counter_ratio(df: DataFrame, keys: Sequence[str], value: str, part: Column, base: Column, out: str) -> DataFrame:
    """Ratio of two counters of the same key, rounded to three digits; no row for a missing or zero base."""
    grouped = df.groupBy(*keys).agg(
        F.max(F.when(part, F.col(value))).alias("__part"), F.max(F.when(base, F.col(value))).alias("__base")
    )
    return grouped.select(*keys, ratio3("__part", "__base").alias(out)).filter(F.col(out).isNotNull())
