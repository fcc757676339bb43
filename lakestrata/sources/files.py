"""File readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SOURCE_FILE = "_source_file"


def read_csv_text(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """CSV with a header row, bound to ``schema`` by position, kept as text.

    Short rows are padded with NULL and surplus fields dropped, so that no
    line stops a load. One line is one record, which keeps big files splittable.
    """
    reader = spark.read.schema(schema).options(header=True, mode="PERMISSIVE")
    return reader.csv(path)


def read_json_lines(
    spark: SparkSession, path: str | list[str], schema: str | None = None
) -> DataFrame:
    """JSON Lines; a given schema saves the inference pass over the files."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def read_json_documents(
    spark: SparkSession, path: str | list[str], schema: str | None = None
) -> DataFrame:
    """Whole-file JSON documents; a top-level array gives one row per element.

    A document cannot be split, so one file is one task: deliver many documents
    of moderate size, or JSON Lines, when the data is large.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path, multiLine=True)


def read_parquet(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Parquet directory; a given schema saves reading a footer on the driver."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def discover_parquet(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Parquet directory whose files may differ in columns.

    Columns of all files are merged, ``key=value`` folders become columns, and
    names starting with ``_`` or ``.`` are skipped; ``pattern`` narrows the file
    names further.
    """
    reader = spark.read.option("mergeSchema", True)
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(path)


def with_source_file(scan: DataFrame) -> DataFrame:
    """Add the file each row came from. Must be applied to the scan itself."""
    return scan.select("*", F.col("_metadata.file_path").alias(SOURCE_FILE))


def source_folder(source_file: Column) -> Column:
    """Name of the folder a file lies in, without the key of ``key=value``."""
    folder = F.substring_index(F.substring_index(source_file, "/", -2), "/", 1)
    return F.substring_index(folder, "=", -1)
