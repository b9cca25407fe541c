"""Outlier alerts on arriving rows, against a table of bounds."""

from __future__ import annotations

import posixpath
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.bounds import outliers
from ..operators.ordered import HOT_ROWS
from .tables import write_batch


def stream_alerts(
    stream: DataFrame, bounds: Callable[[], DataFrame], keys: Sequence[str], value: str, *, root: str,
    upper_only: bool = False, once: bool = True, hot_rows: int = HOT_ROWS,
) -> StreamingQuery:
    """Write the outlying rows of every micro-batch to ``<root>/alerts``.

    ``bounds`` is called for each batch, so refreshed bounds take effect at once. Let it read a stored table: what it
    computes is computed for every batch.
    """
    out = posixpath.join(root, "alerts")

    def step(batch: DataFrame, batch_id: int) -> None:
        found = outliers(batch, bounds(), keys, value, upper_only=upper_only, hot_rows=hot_rows)
        write_batch(found, out, batch_id)

    writer = stream.writeStream.foreachBatch(step).option("checkpointLocation", posixpath.join(root, "checkpoint"))
    return (writer.trigger(availableNow=True) if once else writer).start()


def joined_alerts(stream: DataFrame, bounds: DataFrame, keys: Sequence[str], value: str, *, upper_only: bool = False) -> DataFrame:
    """The outlying rows as a stream, joined to a stored table of bounds with one row per key.

    Every micro-batch reads the table as it then stands. No state is kept, so the result can be appended to any sink.
    """
    above = F.col(value) > F.col("UpperBound")
    outside = above if upper_only else above | (F.col(value) < F.col("LowerBound"))
    return stream.join(bounds, list(keys)).filter(outside)
