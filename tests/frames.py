"""Small frames from literal rows, and results as sorted tuples."""

from __future__ import annotations

from datetime import datetime


def ts(text: str | None) -> datetime | None:
    return datetime.fromisoformat(text) if text else None


def frame(spark, schema: str, *rows):
    return spark.createDataFrame(list(rows), schema)


def tuples(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))
