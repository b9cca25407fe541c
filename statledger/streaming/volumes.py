"""Rates over tumbling event-time windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timeparts import add_seconds, ts_lit, wall_seconds


EPOCH = "1970-01-01 00:00:00"


def windowed_volume(stream: DataFrame, keys: Sequence[str], ts: str, value: str, *, width: str = "2 hours",
                    late: str = "10 minutes") -> DataFrame:
    """Rows and summed value per key and window; a window is final once ``late`` has passed its end.

    Watermarks need a zoned timestamp, so wall-clock times are taken as UTC and
    turned back in the result. On a batch frame the watermark has no effect.
    """
    timed = stream.withColumn("__at", F.timestamp_seconds(wall_seconds(ts))).withWatermark("__at", late)
    grouped = timed.groupBy(F.window("__at", width).alias("__w"), *keys)
    start, end = (add_seconds(ts_lit(EPOCH), F.unix_seconds(F.col(f"__w.{side}"))) for side in ("start", "end"))
    return grouped.agg(F.count(F.lit(1)).alias("MeasureCount"), F.sum(value).alias("Total")).select(
        start.alias("window_start"), end.alias("window_end"), *keys, "MeasureCount", "Total"
    )
