"""Tables and inputs that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN: list[str] = []


def folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which driver and executors share.

    Only where that setting is missing (tests in one process) a temporary folder stands in for it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        if not _OWN:
            _OWN.append(tempfile.mkdtemp(prefix="llm-"))
        base = "file://" + _OWN[0]
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, where: str | None = None) -> DataFrame:
    """Write a frame into the shared folder and read it back, which cuts its lineage."""
    path = f"{where or folder(df.sparkSession)}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


ROWS_PER_BATCH, BYTES_PER_BATCH = 500, 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Let Arrow batches of this session hold at most ``ROWS_PER_BATCH`` rows and about ``BYTES_PER_BATCH``, as one row may hold a long text.

    A batch exists several times over in the executor and its Python worker; Spark's usual 10,000 rows of text take
    hundreds of MB there. Smaller numbers that the session has set stay; a single text beyond the bytes comes alone.
    """
    for name, most in (("maxRecordsPerBatch", ROWS_PER_BATCH), ("maxBytesPerBatch", BYTES_PER_BATCH)):
        name = f"spark.sql.execution.arrow.{name}"
        now = spark.conf.get(name)
        if not now.lstrip("-").isdigit() or not 0 < int(now) <= most:
            spark.conf.set(name, str(most))


def tidied(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The same work on batches, which gives the memory it has freed back to the system: Python workers live on and serve later stages."""

    def kept_small(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):  # another C library
            pass

    return kept_small


MOST_HOT = 1000


def joined_by_key(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Inner join of rows to a table with one row a key and ``rows``, the number of rows that hold it.

    The ``MOST_HOT`` keys with the most rows are sent to all tasks, so the rows of a hot key stay where they are; the others are joined by a shuffle.
    No other key holds more than one in ``MOST_HOT`` of the rows.
    """
    hot = table.orderBy(F.desc("rows"), key).limit(MOST_HOT).drop("rows")
    return rows.join(F.broadcast(hot), key).unionByName(
        rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(table.drop("rows"), key))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
