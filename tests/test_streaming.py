"""Streams over several files: increments across batches, late rows, replays, windows, ingest, alerts."""

import random
from datetime import datetime, timedelta

from frames import ts, tuples
from pyspark.sql import functions as F

from statledger.operators.counters import counter_delta, counter_step
from statledger.streaming.alerts import stream_alerts
from statledger.streaming.deltas import stream_deltas
from statledger.streaming.ingest import ingest, open_landed
from statledger.streaming.tables import drop_state, read_batches, state_before, write_batch, write_compacted
from statledger.streaming.volumes import windowed_volume

SCHEMA = "k STRING, at TIMESTAMP_NTZ, x BIGINT"


def land(spark, folder, rows, parts):
    """Write rows in time order as separate files, oldest first."""
    rows = sorted(rows, key=lambda r: r[1])
    size = -(-len(rows) // parts)
    for i in range(parts):
        part = spark.createDataFrame(rows[i * size:(i + 1) * size], SCHEMA).coalesce(1)
        part.write.mode("append").parquet(folder)
    return spark.createDataFrame(rows, SCHEMA)


def random_rows(seed, n=200):
    rng = random.Random(seed)
    return [(rng.choice("abc"), datetime(2024, 1, 1) + timedelta(minutes=7 * i), rng.randrange(100)) for i in range(n)]


def test_stream_increments_equal_batch_increments(spark, tmp_path):
    everything = land(spark, str(tmp_path / "in"), random_rows(1), 4)
    stream = open_landed(spark, str(tmp_path / "in"), everything.schema, files_per_batch=1)
    stream_deltas(stream, ["k"], "at", ["x"], root=str(tmp_path / "run")).awaitTermination()
    got = read_batches(spark, str(tmp_path / "run" / "deltas"))
    assert got.filter("late").count() == 0
    batch = counter_delta(everything, ["k"], "at", ["x"])
    columns = ["k", "at", "x", "x_delta", "interval_start", "seconds"]
    assert tuples(got, *columns) == tuples(batch, *columns)
    land(spark, str(tmp_path / "in"), [("a", datetime(2024, 2, 1), 500), ("z", datetime(2024, 2, 1), 9)], 1)
    stream_deltas(stream, ["k"], "at", ["x"], root=str(tmp_path / "run")).awaitTermination()  # resumes from its checkpoint
    assert read_batches(spark, str(tmp_path / "run" / "deltas")).count() == 202


def test_late_rows_are_reported_and_leave_the_state_alone(spark):
    last = spark.createDataFrame([("a", ts("2024-01-01 10:00"), 50)], SCHEMA)
    batch = spark.createDataFrame([("a", ts("2024-01-01 09:00"), 40), ("a", ts("2024-01-01 11:00"), 55), ("b", ts("2024-01-01 09:00"), 1)], SCHEMA)
    out, state = counter_step(batch, last, ["k"], "at", ["x"])
    assert tuples(out, "k", "x", "x_delta", "late") == [("a", 40, None, True), ("a", 55, 5, False), ("b", 1, 1, False)]
    assert tuples(state, "k", "x") == [("a", 55), ("b", 1)]


def test_replayed_batch_reads_the_state_before_it(spark, tmp_path):
    path = str(tmp_path / "last")

    def rows(value):
        return spark.createDataFrame([(value,)], "v INT")

    for batch, value in ((0, 1), (1, 2), (3, 4)):
        write_batch(rows(value), path, batch)
    assert state_before(spark, path, 0) is None
    assert tuples(state_before(spark, path, 3)) == [(1,), (2,)]
    write_batch(rows(8), path, 3)
    assert tuples(read_batches(spark, path)) == [(1,), (2,), (8,)]
    write_compacted(rows(11), path, 3)
    write_batch(rows(5), path, 4)
    assert tuples(state_before(spark, path, 3)) == [(1,), (2,)]  # the compaction holds batch 3 as well
    assert tuples(state_before(spark, path, 9)) == [(11,), (5,)]
    drop_state(spark, path, 4)
    assert tuples(state_before(spark, path, 3)) == [(1,), (2,)]  # one compaction alone drops nothing
    write_compacted(rows(16), path, 4)
    drop_state(spark, path, 4)
    assert state_before(spark, path, 3) is None and tuples(state_before(spark, path, 5)) == [(16,)]


def test_a_batch_writes_the_state_of_its_own_keys(spark, tmp_path):
    root, source = str(tmp_path / "run"), str(tmp_path / "in")
    first = [(k, datetime(2024, 1, 1), i) for i, k in enumerate("abcd")] + [(None, datetime(2024, 1, 1), 7)]
    later = [[("b", datetime(2024, 1, 1, n), 10 * n)] for n in (1, 2)] + [[(None, datetime(2024, 1, 1, 3), 9)]]
    for rows in (first, *later):
        land(spark, source, rows, 1)
        stream = open_landed(spark, source, spark.createDataFrame(first, SCHEMA).schema)
        stream_deltas(stream, ["k"], "at", ["x"], root=root, compact_every=3).awaitTermination()
    state = [spark.read.parquet(f"{root}/last/batch={n}") for n in range(4)]
    assert [part.count() for part in state] == [5, 1, 1, 1]
    assert tuples(state[2], "k", "x") == [("b", 20)]
    assert tuples(spark.read.parquet(f"{root}/last/compacted=2"), "k", "x") == [("a", 0), ("b", 20), ("c", 2), ("d", 3), (None, 7)]
    deltas = read_batches(spark, f"{root}/deltas").filter("k = 'b' OR k IS NULL")
    assert tuples(deltas, "k", "x", "x_delta") == [("b", 1, 1), ("b", 10, 9), ("b", 20, 10), (None, 7, 7), (None, 9, 2)]


def test_windows_equal_batch_once_final(spark, tmp_path):
    everything = land(spark, str(tmp_path / "in"), random_rows(2), 4)
    stream = windowed_volume(open_landed(spark, str(tmp_path / "in"), everything.schema, files_per_batch=1), ["k"], "at", "x")
    query = (
        stream.writeStream.format("memory").queryName("volumes").outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    last = max(r["at"] for r in everything.collect())
    batch = windowed_volume(everything, ["k"], "at", "x").filter(F.col("window_end") <= F.lit(str(last - timedelta(minutes=10))).cast("timestamp_ntz"))
    assert tuples(spark.table("volumes")) == tuples(batch)


def test_ingest_is_exactly_once(spark, tmp_path):
    everything = land(spark, str(tmp_path / "in"), random_rows(3), 3)
    source = open_landed(spark, str(tmp_path / "in"), everything.schema)
    for _ in range(2):
        ingest(source, str(tmp_path / "out"), str(tmp_path / "check"), ts="at").awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 200


def test_stream_alerts(spark, tmp_path):
    everything = land(spark, str(tmp_path / "in"), random_rows(4), 2)
    bounds = spark.createDataFrame([(k, 50, 1.0, 10.0, 90.0, 9) for k in "ab"], "k STRING, Mean BIGINT, StandardDev DOUBLE, LowerBound DOUBLE, UpperBound DOUBLE, SampleSize BIGINT")
    source = open_landed(spark, str(tmp_path / "in"), everything.schema, files_per_batch=1)
    stream_alerts(source, lambda: bounds, ["k"], "x", root=str(tmp_path / "run"), upper_only=True).awaitTermination()
    got = read_batches(spark, str(tmp_path / "run" / "alerts"))
    assert tuples(got, "k", "at", "x") == tuples(everything.filter("x > 90 AND k IN ('a', 'b')"), "k", "at", "x")
