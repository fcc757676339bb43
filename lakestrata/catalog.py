"""Databases and tables of the Spark catalog."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from lakestrata.layout import delete_folder, materialize
from lakestrata.operators import keep_latest, upsert

# Property of a view that stands for a table: the table with the rows of its present version.
VERSION = "lakestrata.version"


def qualified(database: str, table: str) -> str:
    return f"`{database}`.`{table}`"


def create_database(spark: SparkSession, database: str, location: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{location}'")


def recreate_table(
    spark: SparkSession,
    database: str,
    table: str,
    columns: str,
    location: str,
    partitioned_by: str | None = None,
    options: Mapping[str, str] | None = None,
    buckets: tuple[str, int] | None = None,
) -> None:
    """Declare an external Parquet table anew. Files at ``location`` stay as they are.

    ``buckets`` names a column and a number of buckets: rows are then written by its hash, sorted inside a bucket.

    A partitioned table is empty until its folders are picked up by
    :func:`refresh_partitions` or written by an insert. ``columns`` may use
    VARCHAR(n): an insert of longer text then fails.
    """
    name = qualified(database, table)
    listed = ", ".join(f"'{k}' '{v}'" for k, v in (options or {}).items())
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet"
        + (f" OPTIONS ({listed})" if listed else "")
        + (f" PARTITIONED BY ({partitioned_by})" if partitioned_by else "")
        + ("" if buckets is None else f" CLUSTERED BY ({buckets[0]}) SORTED BY ({buckets[0]}) INTO {buckets[1]} BUCKETS")
        + f" LOCATION '{location}'"
    )


def discover_table(
    spark: SparkSession,
    database: str,
    table: str,
    location: str,
    file_format: str = "parquet",
    **options: str,
) -> None:
    """Declare a table with the columns and partitions found at ``location``.

    Columns of all Parquet files are merged. Run again after new files came:
    the table then has their columns and folders as well.
    """
    name = qualified(database, table)
    if file_format == "parquet":
        options = {"mergeSchema": "true", **options}
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, path=location, source=file_format, **options)
    if any(column.isPartition for column in spark.catalog.listColumns(name)):
        refresh_partitions(spark, database, table)


def table_exists(spark: SparkSession, database: str, table: str) -> bool:
    return spark.catalog.tableExists(qualified(database, table))


def version_table(spark: SparkSession, database: str, table: str) -> str | None:
    """The table behind a view made by :mod:`lakestrata.publishing`; None for any other."""
    if not table_exists(spark, database, table):
        return None
    properties = spark.sql(f"SHOW TBLPROPERTIES {qualified(database, table)}")
    found = properties.where(F.col("key") == VERSION).first()
    return found["value"] if found else None


def stored(spark: SparkSession, database: str, table: str) -> str:
    """Name of the table that holds the rows: of the present version, or of the table itself."""
    return qualified(database, version_table(spark, database, table) or table)


def refresh_partitions(spark: SparkSession, database: str, table: str) -> None:
    """Bring the catalog in line with the partition folders present."""
    spark.catalog.recoverPartitions(stored(spark, database, table))


def insert_by_name(df: DataFrame, database: str, table: str, *, overwrite: bool = False) -> None:
    """Insert with columns matched by name, whatever their order in ``df``."""
    name = qualified(database, table)
    wanted = df.sparkSession.table(name).columns
    df.select(*wanted).write.insertInto(name, overwrite=overwrite)


def replace_contents(df: DataFrame, database: str, table: str, location: str) -> None:
    """Publish ``df``, which may read the table itself, as the table's new contents.

    The rows go to ``location``, a new directory, and the table is pointed there
    once they are complete, so readers see the old or the new rows, never a mix.
    A partitioned table is refused, as its partitions have locations of their own: see :func:`merge_partitions`.
    """
    spark = df.sparkSession
    if any(column.isPartition for column in spark.catalog.listColumns(qualified(database, table))):
        raise ValueError(f"{database}.{table} is partitioned; load it into a new table instead")
    df.write.parquet(location)
    spark.sql(f"ALTER TABLE {qualified(database, table)} SET LOCATION '{location}'")
    spark.catalog.refreshTable(qualified(database, table))


def merge_partitions(
    changes: DataFrame,
    database: str,
    table: str,
    keys: Sequence[str],
    newest: Sequence[str | Column] = (),
    *,
    keep_when_null: bool = True,
) -> list[Row]:
    """Merge ``changes`` into a partitioned table, rewriting only the partitions they touch.

    The rules are those of :func:`lakestrata.operators.upsert`. Touched are the partitions that the changes belong to and
    those in which a changed key lies now, as a row may move; the latter are looked up from keys alone, and not
    at all when the keys hold all partition columns. Rows of other partitions are not read and their
    files stay. The merged rows are complete before the first partition is replaced; a partition that lost its last row
    is dropped. Returns the touched partitions.
    """
    spark, name = changes.sparkSession, qualified(database, table)
    target = spark.table(name)
    parts = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    if not parts:
        raise ValueError(f"{database}.{table} is not partitioned; replace its contents instead")
    keys = list(keys)
    latest = keep_latest(changes.dropna(subset=keys), keys, newest)
    latest = materialize(latest.select(*target.columns), "changes")
    moved_from = target.select(*keys, *[p for p in parts if p not in keys])
    if not set(parts) <= set(keys):
        at_home = moved_from.join(latest.select(*keys), keys, "left_semi").select(*parts)
        if keep_when_null:
            # A change without a value here stays where its row lies.
            latest = materialize(_with_own_partition(latest, moved_from, keys, parts), "changes")
        touched = latest.select(*parts).unionByName(at_home).distinct().collect()
    else:
        touched = latest.select(*parts).distinct().collect()
    if not touched:
        return []
    before = target.where(_any_of(touched, parts))
    merged = upsert(before, latest, keys, keep_when_null=keep_when_null)
    merged = materialize(merged, "merged-partitions")
    mode = "spark.sql.sources.partitionOverwriteMode"
    set_before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        insert_by_name(merged.hint("rebalance", *parts), database, table, overwrite=True)
    finally:
        spark.conf.set(mode, set_before)
    left = set(merged.select(*parts).distinct().collect())
    location = table_location(spark, database, table)
    for part in set(touched) - left:
        spec = ", ".join(f"`{p}` = {_literal(part[p])}" for p in parts)
        where = spark.sql(f"SHOW PARTITIONS {name} PARTITION ({spec})").collect()
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({spec})")
        for found in where:
            delete_folder(spark, f"{location}/{found['partition']}")
    spark.catalog.refreshTable(name)
    return touched


def _with_own_partition(latest: DataFrame, at: DataFrame, keys: list[str], parts: list[str]) -> DataFrame:
    """Changes whose partition columns are filled from the row they change."""
    own = [p for p in parts if p not in keys]
    homes = at.join(latest.select(*keys), keys, "left_semi").select(*keys, *[F.col(p).alias(f"_own_{p}") for p in own])
    return latest.join(homes, keys, "left").select(
        *[F.coalesce(c, f"_own_{c}").alias(c) if c in own else c for c in latest.columns]
    )


def _any_of(rows: Sequence[Row], columns: Sequence[str]) -> Column:
    """Whether the columns hold one of the combinations; a filter on partitions, which chooses folders."""
    if len(columns) == 1:
        values = [r[0] for r in rows if r[0] is not None]
        found = F.col(columns[0]).isin(values) if values else F.lit(False)
        return found | F.col(columns[0]).isNull() if len(values) < len(rows) else found
    each = [functools.reduce(Column.__and__, [F.col(c).eqNullSafe(F.lit(r[c])) for c in columns]) for r in rows]
    return functools.reduce(Column.__or__, each)


def _literal(value: object) -> str:
    return "NULL" if value is None else "'" + str(value).replace("'", "\\'") + "'"


def table_location(spark: SparkSession, database: str, table: str) -> str | None:
    """Where the rows of a table, or of its present version, lie; None when there is no such table."""
    if not table_exists(spark, database, table):
        return None
    described = spark.sql(f"DESCRIBE FORMATTED {stored(spark, database, table)}")
    return described.where("col_name = 'Location'").first()["data_type"]


def drop_table(spark: SparkSession, database: str, table: str) -> None:
    """Forget an external table; its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {qualified(database, table)}")
