"""Snapshot ingest: files that land become rows of a partitioned history table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions.timeparts import wall_seconds
from ..operators.timewindow import PARTITION
from ..sources.history import RUN, STREAMED


def open_landed(spark: SparkSession, path: str, schema: StructType, *, fmt: str = "parquet",
                files_per_batch: int | None = None, names: str | None = None) -> DataFrame:
    """A stream over the files of a landing folder, with a declared schema; ``names`` is a file name pattern."""
    reader = spark.readStream.schema(schema).format(fmt)
    if names:
        reader = reader.option("pathGlobFilter", names)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def reported_once(stream: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """Rows that further polls report again, within ``delay`` of their time ``ts``, only once.

    Spark keeps the keys of that time in its state store and forgets older ones. Undated rows have no place in that: they are left out.
    """
    at = "__at"
    timed = stream.filter(F.col(ts).isNotNull()).withColumn(at, F.timestamp_seconds(wall_seconds(ts)))
    return timed.withWatermark(at, delay).dropDuplicatesWithinWatermark(list(keys)).drop(at)


def ingest(stream: DataFrame, path: str, checkpoint: str, *, ts: str = "Date", once: bool = True) -> StreamingQuery:
    """Append the stream to a history table, each file exactly once.

    The rows lie under the day of their stamp, in a run named by ``STREAMED`` and the number of the micro-batch, beside
    loaded snapshots; ``read_history`` reads both. A batch that is repeated replaces its own runs.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        dated = batch.withColumn(PARTITION, F.to_date(ts)).withColumn(RUN, F.lit(f"{STREAMED}-{batch_id}"))
        dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PARTITION, RUN).parquet(path)

    writer = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
