"""Session settings the library is tested with. Any Spark 4 session works."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split skewed joins also where a following aggregate could have reused their partitioning
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # no call-site capture per column expression: plans are built several times faster
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def session(app: str = "statledger", master: str | None = None, **settings) -> SparkSession:
    """Get or create a session; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in (SETTINGS | {k.replace("__", "."): v for k, v in settings.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
