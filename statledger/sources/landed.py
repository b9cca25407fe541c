"""Readers for landed raw extracts: one directory per view, partitioned by server and database."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.timeparts import ts_lit
from .scratch import stored


def read_landed(spark: SparkSession, path: str, schema: StructType, *, fmt: str = "parquet", **options) -> DataFrame:
    """All databases of one view as one dataset with a declared schema.

    ``DB_Name=...`` (and ``server_name=...``) directories become columns; a filter
    on them prunes directories. ``fmt`` may be any Spark source, e.g. ``csv``,
    ``json`` or ``orc``.
    """
    return spark.read.schema(schema).format(fmt).options(**options).load(path)


REJECTED = "rejected_row"


def read_checked(spark: SparkSession, path: str, schema: StructType, *, fmt: str = "csv", **options) -> tuple[DataFrame, DataFrame]:
    """Rows that fit the declared schema, and those that don't, as ``rejected_row`` text.

    A value that can't be read as its type, or a missing or surplus column, rejects the whole row; the others are not touched.
    ``fmt`` is a text source: ``csv``, ``json`` or ``xml``. The texts are parsed once; the parsed rows lie in the shared folder.
    """
    full = StructType([*schema.fields, StructField(REJECTED, StringType())])
    read = spark.read.schema(full).format(fmt).options(mode="PERMISSIVE", columnNameOfCorruptRecord=REJECTED, **options).load(path)
    read = stored(read, "checked")
    return read.filter(F.col(REJECTED).isNull()).drop(REJECTED), read.filter(F.col(REJECTED).isNotNull()).select(REJECTED)


def rejects_as_errors(rejected: DataFrame, table: str, as_of) -> DataFrame:
    """Rejected rows in the shape of the errors table."""
    return rejected.select(ts_lit(as_of).alias("Date"), F.lit(table).alias("TableName"), F.concat(F.lit("rejected: "), REJECTED).alias("Message"))


def read_xml(spark: SparkSession, path: str, schema: StructType, *, row_tag: str, **options) -> DataFrame:
    """The elements ``row_tag`` of XML files, one row each; attributes are columns with a leading ``_``."""
    return spark.read.schema(schema).format("xml").options(rowTag=row_tag, **options).load(path)


def read_jdbc(spark: SparkSession, url: str, table: str, *, split: str | None = None, lower: int = 0,
              upper: int = 0, parts: int = 1, **options) -> DataFrame:
    """One view over JDBC, read in ``parts`` ranges of the numeric column ``split``."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if split:
        reader = reader.options(partitionColumn=split, lowerBound=lower, upperBound=upper, numPartitions=parts)
    return reader.load()


def fan_in(per_database: Mapping[str, DataFrame], column: str = "DB_Name") -> DataFrame:
    """Stack extracts held as separate frames, naming the database of each row."""
    named = [df.withColumn(column, F.lit(name)) for name, df in per_database.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def user_databases(df: DataFrame, first_user_database: int = 5) -> DataFrame:
    """Leave out system databases by their id."""
    return df.filter(F.col("database_id") >= first_user_database)
