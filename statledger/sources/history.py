"""History tables on a shared file system: parquet, partitioned by snapshot day and run.

Every load replaces its own ``snapshot_date``/``snapshot_run`` folder, so a rerun of
the same ``as_of`` replaces its rows, also when it has none, and touches nothing
else. While a rerun is written the folder is incomplete; readers that must not see
that need a committer or table format with atomic replacement.

Streams append to the same layout: their rows lie under runs ``STREAMED`` of
their day and count by their own stamps. Undated rows count for every time.
"""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from ..functions.timeparts import days_before, parse_as_of, ts_lit
from ..operators.timewindow import PARTITION
from .schemas import STAMP, conform, schema

RUN = "snapshot_run"
STREAMED = "streamed"


def table_path(root: str, table: str) -> str:
    return posixpath.join(root, table)


def run_name(as_of, part: str = "") -> str:
    """Folder name of a load: its time of day, and ``part`` where several loads of one time stay side by side."""
    at = parse_as_of(as_of).strftime("%H%M%S")
    return f"{at}-{part}" if part else at


def append_snapshot(df: DataFrame, root: str, table: str, as_of, *, extra=(), part: str = "") -> None:
    """Write the rows of one load, in the order they come in: every reader here takes whole days, and sorting by name took half of the write."""
    shaped = conform(df, table, extra)
    folder = f"{PARTITION}={parse_as_of(as_of).date().isoformat()}/{RUN}={run_name(as_of, part)}"
    shaped.write.mode("overwrite").option("compression", "zstd").parquet(posixpath.join(table_path(root, table), folder))


def read_history(spark: SparkSession, root: str, table: str, *, extra=(), until=None) -> DataFrame:
    """All loads of a table, or those up to ``until``. A table that was never written is empty.

    Streamed rows of the last day are decided one by one by their stamp; undated ones always belong.
    """
    own = StructType([StructField(c, StringType()) for c in extra] + [f for f in schema(table) if f.name not in extra])
    return read_parts(spark, table_path(root, table), own, until=until, stamp=STAMP.get(table, "Date"))


def read_parts(spark: SparkSession, path: str, own: StructType, *, until=None, stamp: str | None = None) -> DataFrame:
    """All loads under ``path`` with the columns ``own``, or those up to ``until``; rows of streams by their ``stamp``."""
    full = StructType(own.fields + [StructField(PARTITION, DateType()), StructField(RUN, StringType())])
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], full)
    df = spark.read.schema(full).parquet(path)
    if until is not None:
        at = parse_as_of(until)
        day, run = F.lit(at.date().isoformat()).cast("date"), at.strftime("%H%M%S")
        in_time = F.substring(RUN, 1, 6) <= run
        if stamp:
            streamed = F.coalesce(F.col(stamp) <= ts_lit(until), F.lit(True))
            in_time = F.when(F.col(RUN).startswith(STREAMED), streamed).otherwise(in_time)
        df = df.filter(F.col(PARTITION).isNull() | (F.col(PARTITION) < day) | ((F.col(PARTITION) == day) & in_time))
    return df


def expired_partitions(spark: SparkSession, root: str, table: str, days, as_of) -> DataFrame:
    """Snapshot days that lie wholly before the retention limit, for dropping as directories.

    Only the day before the limit's own day and older qualify; rows of the limit
    day are decided one by one by ``apply_retention``.
    """
    limit = days_before(as_of, days).date().isoformat()
    listed = read_history(spark, root, table).select(PARTITION).distinct()
    return listed.filter(F.col(PARTITION) < F.lit(limit).cast("date"))


def drop_expired(spark: SparkSession, root: str, table: str, days, as_of) -> int:
    """Remove the directories of expired snapshot days; returns how many."""
    base = table_path(root, table)
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    fs = path_of(base).getFileSystem(spark._jsc.hadoopConfiguration())
    limit = days_before(as_of, days).date().isoformat()
    if not fs.exists(path_of(base)):
        return 0
    prefix, dropped = f"{PARTITION}=", 0
    for status in fs.listStatus(path_of(base)):  # one entry per day
        name = status.getPath().getName()
        if name.startswith(prefix) and name[len(prefix):] < limit:
            fs.delete(status.getPath(), True)
            dropped += 1
    return dropped
