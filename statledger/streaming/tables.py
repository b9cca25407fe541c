"""Tables written by micro-batches: one folder per batch, so a replayed batch replaces its own output.

A state table holds, for each batch, the rows of the keys that batch changed
(``batch=N``), and now and then one row per key for all batches so far
(``compacted=N``). What stands before a batch is the newest compaction before
it and the batches after that one.
"""

from __future__ import annotations

import posixpath
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

BATCH = "batch"
COMPACTED = "compacted"


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Replace the output of one micro-batch."""
    df.write.mode("overwrite").parquet(posixpath.join(path, f"{BATCH}={batch_id}"))


def write_compacted(df: DataFrame, path: str, batch_id: int) -> None:
    """Replace the compaction of all micro-batches up to ``batch_id``."""
    df.write.mode("overwrite").parquet(posixpath.join(path, f"{COMPACTED}={batch_id}"))


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """The output of all micro-batches."""
    return spark.read.parquet(path).drop(BATCH)


def _folder(spark: SparkSession, path: str):
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    return path_of, path_of(path).getFileSystem(spark._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, path: str, kind: str = BATCH) -> list[int]:
    """Numbers of the complete folders of a kind under a path, newest first."""
    path_of, fs = _folder(spark, path)
    if not fs.exists(path_of(path)):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(path_of(path))]
    found = sorted((int(n.split("=")[1]) for n in names if n.startswith(f"{kind}=")), reverse=True)
    return [n for n in found if fs.exists(path_of(posixpath.join(path, f"{kind}={n}", "_SUCCESS")))]


def state_before(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    """Rows of the state as the micro-batches before ``batch_id`` left it, perhaps several a key; nothing before the first."""
    base = max((n for n in _numbers(spark, path, COMPACTED) if n < batch_id), default=None)
    parts = [f"{BATCH}={n}" for n in _numbers(spark, path) if n < batch_id and (base is None or n > base)]
    parts += [] if base is None else [f"{COMPACTED}={base}"]
    if not parts:
        return None
    return reduce(DataFrame.unionByName, (spark.read.parquet(posixpath.join(path, part)) for part in parts))


def drop_state(spark: SparkSession, path: str, batch_id: int, keep: int = 2) -> None:
    """Remove what no replay can ask for any more: all before the oldest of the last ``keep`` compactions up to ``batch_id``."""
    kept = [n for n in _numbers(spark, path, COMPACTED) if n <= batch_id][:keep]
    if len(kept) < keep:
        return
    path_of, fs = _folder(spark, path)
    for kind in (BATCH, COMPACTED):
        for number in _numbers(spark, path, kind):
            if number < kept[-1]:
                fs.delete(path_of(posixpath.join(path, f"{kind}={number}")), True)
