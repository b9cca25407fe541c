"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import posixpath
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: list[str] = []


def shared_folder(spark: SparkSession) -> str | None:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the shared one; a local one only where none is set and all runs in one process."""
    base = shared_folder(spark)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        if not _OWN:
            _OWN.append(tempfile.mkdtemp(prefix="statledger-"))
        base = _OWN[0]
    return posixpath.join(base, "statledger", name, uuid.uuid4().hex)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame into the shared folder and read it back, so that all later uses see the same rows."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
