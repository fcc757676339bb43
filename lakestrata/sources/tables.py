"""Readers of catalogued and partitioned tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F


def read_table(spark: SparkSession, database: str, table: str) -> DataFrame:
    return spark.table(f"`{database}`.`{table}`")


def read_partition_range(
    spark: SparkSession,
    path: str,
    column: str,
    first: dt.date,
    last: dt.date,
    schema: str | None = None,
) -> DataFrame:
    """Days ``first`` to ``last`` (both included) of a table laid out by day."""
    days = [first + dt.timedelta(days=n) for n in range((last - first).days + 1)]
    return _read_folders(spark, path, column, days, schema).where(F.col(column).between(first, last))


def read_days(
    spark: SparkSession,
    path: str,
    column: str,
    days: Collection[dt.date],
    schema: str | None = None,
) -> DataFrame:
    """The given days of a table laid out by day."""
    days = sorted(set(days))
    return _read_folders(spark, path, column, days, schema).where(F.col(column).isin(days))


def _read_folders(
    spark: SparkSession, path: str, column: str, days: Collection[dt.date], schema: str | None
) -> DataFrame:
    """The folders of the days are named in the path, so the files of other days are not even listed.

    Days without a folder have no rows. The partition column is restored from the folder names. Without any of
    the folders the whole table is named, for the caller's filter to leave nothing of.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    folders = ",".join(f"{column}={day}" for day in days)
    try:
        return reader.option("basePath", path).parquet(f"{path}/{{{folders}}}")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return reader.parquet(path)
