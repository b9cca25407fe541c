"""Streaming jobs over the sample events, run until the input is used up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.bounds import sigma_bounds
from ..streaming.alerts import joined_alerts, stream_alerts
from ..streaming.deltas import stream_deltas
from ..streaming.ingest import ingest, open_landed, reported_once
from ..streaming.tables import read_batches
from ..streaming.volumes import windowed_volume
from ..sources.scratch import scratch

EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def _events(spark: SparkSession, folder: str) -> DataFrame:
    stream = open_landed(spark, folder, StructType.fromDDL(EVENTS), names="events.parquet")
    return stream.withColumn("cents", F.floor(F.col("value") * 100).cast("bigint"))


def volumes(spark: SparkSession, folder: str) -> DataFrame:
    root = scratch(spark, "volumes")
    stream = windowed_volume(_events(spark, folder), ["event_type"], "ts", "cents")
    query = (
        stream.writeStream.format("parquet").outputMode("append").option("path", f"{root}/out")
        .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/out")


def deltas(spark: SparkSession, folder: str) -> DataFrame:
    """The events of each week are landed by themselves, in as many files as their size asks for, so the increments run over several micro-batches."""
    root = scratch(spark, "deltas")
    events = spark.read.parquet(f"{folder}/events.parquet")
    week = F.coalesce(F.floor(F.dayofmonth("ts") / 8), F.lit(0))
    for number in range(4):  # dayofmonth div 8; files are taken in the order they landed
        events.filter(week == number).write.mode("append").parquet(f"{root}/landed")
    files = len(spark.read.parquet(f"{root}/landed").inputFiles())
    landed = open_landed(spark, f"{root}/landed", StructType.fromDDL(EVENTS), files_per_batch=max(1, -(-files // 4)))
    stream = landed.select("user_id", "ts", (F.col("event_id") * 13 % 5000).alias("counter"), "event_id")
    stream_deltas(stream, ["user_id"], "ts", ["counter", "event_id"], root=root, first="zero").awaitTermination()
    return read_batches(spark, f"{root}/deltas").select("user_id", "event_id", "counter_delta", "seconds", "late")


def alerts(spark: SparkSession, folder: str) -> DataFrame:
    root = scratch(spark, "alerts")
    events = spark.read.parquet(f"{folder}/events.parquet")
    cents = events.withColumn("cents", F.floor(F.col("value") * 100).cast("bigint"))
    stored = f"{root}/bounds"  # made once; every micro-batch reads the few stored rows
    limits = sigma_bounds(cents, ["event_type"], "cents")
    limits.write.parquet(stored)

    def bounds() -> DataFrame:
        return spark.read.schema(limits.schema).parquet(stored)

    stream = _events(spark, folder).select("event_id", "event_type", "cents")
    stream_alerts(stream, bounds, ["event_type"], "cents", root=root).awaitTermination()
    return read_batches(spark, f"{root}/alerts").select("event_id", "event_type", "cents", "Mean", "SampleSize")


def _appended(stream: DataFrame, root: str) -> DataFrame:
    """What a stream appends until its input is used up."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", f"{root}/out")
    writer.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{root}/out")


def joined(spark: SparkSession, folder: str) -> DataFrame:
    """Alerts from a stream joined to a stored table of bounds."""
    root = scratch(spark, "joined")
    events = spark.read.parquet(f"{folder}/events.parquet")
    limits = sigma_bounds(events.withColumn("cents", F.floor(F.col("value") * 100).cast("bigint")), ["event_type"], "cents")
    limits.write.parquet(f"{root}/bounds")
    stream = _events(spark, folder).select("event_id", "event_type", "cents")
    found = joined_alerts(stream, spark.read.schema(limits.schema).parquet(f"{root}/bounds"), ["event_type"], "cents")
    return _appended(found.select("event_id", "event_type", "cents", "Mean", "SampleSize"), root)


def reported(spark: SparkSession, folder: str) -> DataFrame:
    """All events landed twice, as two polls report them, taken once."""
    root = scratch(spark, "reported")
    events = spark.read.parquet(f"{folder}/events.parquet")
    for _ in range(2):
        events.write.mode("append").parquet(f"{root}/landed")
    landed = open_landed(spark, f"{root}/landed", StructType.fromDDL(EVENTS))
    return _appended(reported_once(landed, ["event_id"], "ts", "2 hours").select("event_id", "ts", "user_id"), root)


def ingest_runs(spark: SparkSession, folder: str, root: str) -> None:
    """All events as rows of the history table ``recent_runs`` under ``root``."""
    stream = _events(spark, folder).select(
        F.col("event_type").alias("DB_Name"), F.col("user_id").cast("string").alias("SP_Name"),
        F.col("event_id").alias("last_elapsed_time"), F.col("ts").alias("Date"),
    )
    ingest(stream, f"{root}/recent_runs", f"{root}/checkpoint_of_recent_runs").awaitTermination()


def history(spark: SparkSession, folder: str) -> DataFrame:
    root = scratch(spark, "history")
    stream = _events(spark, folder).select("event_id", "ts", "event_type", "cents")
    ingest(stream, f"{root}/out", f"{root}/checkpoint", ts="ts").awaitTermination()
    loaded = spark.read.parquet(f"{root}/out")
    return loaded.groupBy("snapshot_date", "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents")
    )
