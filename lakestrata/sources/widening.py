"""Parquet directories whose files disagree on the type of a column.

Footers are read by Spark, many at a time: as long as those of a part of the folders agree, one look is
enough for the part. Where they do not, the part is halved until the folders, or the files, that differ stand
alone. Their types are then widened to one that holds the values of all, which the scan
converts to while it reads; types without such a common one are reported with a path of each.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


@dataclass
class Agreed:
    """Paths whose footers merge, and the schema they merge to."""

    paths: list[str]
    schema: T.StructType


class TypeConflict(ValueError):
    """Two files hold a column in types that no type of a scan covers."""


def wider(one: T.DataType, two: T.DataType) -> T.DataType | None:
    """The narrowest type that holds every value of both without loss; None when there is none."""
    if one == two:
        return one
    for a, b in ((one, two), (two, one)):
        if isinstance(a, T.NullType):
            return b
        if isinstance(a, INTEGERS) and isinstance(b, INTEGERS):
            return max(a, b, key=lambda kind: INTEGERS.index(type(kind)))
        # A whole number of 64 bits has more digits than a double.
        if isinstance(a, INTEGERS[:3]) and isinstance(b, T.DoubleType):
            return b
        if isinstance(a, T.FloatType) and isinstance(b, T.DoubleType):
            return b
        if isinstance(a, T.DateType) and isinstance(b, T.TimestampNTZType):
            return b
    if isinstance(one, T.DecimalType) and isinstance(two, T.DecimalType):
        scale = max(one.scale, two.scale)
        digits = max(one.precision - one.scale, two.precision - two.scale) + scale
        return T.DecimalType(digits, scale) if digits <= 38 else None
    if isinstance(one, T.ArrayType) and isinstance(two, T.ArrayType):
        element = wider(one.elementType, two.elementType)
        return element and T.ArrayType(element, True)
    if isinstance(one, T.MapType) and isinstance(two, T.MapType):
        key, value = wider(one.keyType, two.keyType), wider(one.valueType, two.valueType)
        return T.MapType(key, value, True) if key and value else None
    if isinstance(one, T.StructType) and isinstance(two, T.StructType):
        kinds = {f.name: f.dataType for f in one}
        for field in two:
            kinds[field.name] = wider(kinds.get(field.name, T.NullType()), field.dataType)
        return None if None in kinds.values() else T.StructType([T.StructField(n, k) for n, k in kinds.items()])
    return None


def _reader(spark: SparkSession, pattern: str | None):
    return spark.read if pattern is None else spark.read.option("pathGlobFilter", pattern)


def _files(spark: SparkSession, path: str, pattern: str | None) -> DataFrame:
    found = _reader(spark, pattern).option("recursiveFileLookup", True).format("binaryFile").load(path)
    return found.select(F.col("_metadata.file_path").alias("file"))


def agreeing(spark: SparkSession, paths: Sequence[str], pattern: str | None = None) -> list[Agreed]:
    """The paths in parts whose footers merge; a folder that does not agree with itself is taken file by file."""
    paths = list(paths)
    try:
        return [Agreed(paths, _reader(spark, pattern).option("mergeSchema", True).parquet(*paths).schema)]
    except Exception as failure:
        if "CANNOT_MERGE" not in str(failure):
            raise
    if len(paths) == 1:
        # One row per file of the folder.
        paths = sorted(r["file"] for r in _files(spark, paths[0], pattern).collect())
    half = len(paths) // 2
    return agreeing(spark, paths[:half], pattern) + agreeing(spark, paths[half:], pattern)


def widened_schema(parts: Sequence[Agreed]) -> T.StructType:
    """One schema for all parts; fails naming the paths whose types have nothing in common."""
    kinds: dict[str, tuple[T.DataType, str]] = {}
    for part in parts:
        for field in part.schema:
            known, where = kinds.get(field.name, (T.NullType(), part.paths[0]))
            kind = wider(known, field.dataType)
            if kind is None:
                raise TypeConflict(
                    f"column {field.name} is {known.simpleString()} in {where} "
                    f"and {field.dataType.simpleString()} in {part.paths[0]}"
                )
            kinds[field.name] = kind, where if kind == known else part.paths[0]
    return T.StructType([T.StructField(name, kind) for name, (kind, _) in kinds.items()])


def discover_widened(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Parquet directory whose files may differ in columns and in the width of their types.

    Like :func:`discover_parquet`, which serves as long as types agree: columns of all files are merged, ``key=value``
    folders become columns, hidden files are skipped. One scan, so filters and columns are pushed down.
    """
    try:
        return _reader(spark, pattern).option("mergeSchema", True).parquet(path)
    except Exception as failure:
        if "CANNOT_MERGE" not in str(failure):
            raise
    folder = F.regexp_extract("file", "^(.*)/[^/]*$", 1)
    folders = _files(spark, path, pattern).select(folder.alias("folder"))
    # One row per folder.
    parts = agreeing(spark, sorted(r["folder"] for r in folders.distinct().collect()), pattern)
    return _reader(spark, pattern).schema(widened_schema(parts)).parquet(path)
