"""Counter increments across micro-batches.

The last sample of each key is kept in a table, not in executor memory. A batch
reads the samples of its own keys, writes its increments, and writes the new
last samples of those keys alone; every ``COMPACT_EVERY`` batches the table is
compacted into one row per key. Outputs are per batch and complete before they
are read, so a batch that is run again after a failure gives the same result.
"""

from __future__ import annotations

import posixpath
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.counters import counter_step
from ..operators.ordered import latest_per, same_keys
from .tables import drop_state, state_before, write_batch, write_compacted

COMPACT_EVERY = 20


def samples_of(batch: DataFrame, held: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """The last sample of each key of ``batch``. A key's stored samples grow with time, so the newest is the last."""
    keys = list(keys)
    changed = batch.select(*keys).distinct().alias("c")
    return latest_per(held.alias("s").join(changed, same_keys("s", "c", keys), "left_semi"), keys, ts)


def stream_deltas(
    stream: DataFrame, keys: Sequence[str], ts: str, columns: Sequence[str], *, root: str, once: bool = True,
    compact_every: int = COMPACT_EVERY, **policy
) -> StreamingQuery:
    """Run :func:`counter_step` on every micro-batch; increments go to ``<root>/deltas``, changed keys to ``<root>/last``."""
    state, out = posixpath.join(root, "last"), posixpath.join(root, "deltas")

    def step(batch: DataFrame, batch_id: int) -> None:
        kept = []

        def keep(df: DataFrame) -> DataFrame:
            kept.append(df.persist())
            return kept[-1]

        try:
            rows = keep(batch)
            held = state_before(batch.sparkSession, state, batch_id)
            last = None if held is None else samples_of(rows, held, keys, ts)
            deltas, newest = counter_step(rows, last, keys, ts, columns, keep=keep, **policy)
            write_batch(deltas, out, batch_id)
            write_batch(newest, state, batch_id)
            if batch_id % compact_every == compact_every - 1:
                everything = state_before(batch.sparkSession, state, batch_id + 1)
                write_compacted(latest_per(everything, keys, ts), state, batch_id)
                drop_state(batch.sparkSession, state, batch_id)
        finally:
            for df in kept:
                df.unpersist()

    writer = stream.writeStream.foreachBatch(step).option("checkpointLocation", posixpath.join(root, "checkpoint"))
    return (writer.trigger(availableNow=True) if once else writer).start()
