"""Tables that are replaced while others read them.

What readers know as a table is a view on a version, a table of its own with files of its own. A load fills
the next version and then points the view there in one statement, so every read sees the old rows or the
new ones. Older versions stay until they are released. A version may take over days of the one before: its
partitions then point to the folders where these days lie, and nothing is copied.

One load at a time may run for a table. What a load that died has left goes with the next release.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from lakestrata import catalog
from lakestrata.layout import delete_folder, folder_names

MARK = "__v"
ADDED_AT_ONCE = 500  # partitions per statement


def numbers(spark: SparkSession, database: str, table: str) -> list[int]:
    """Numbers of all versions there are tables of, published or not."""
    names = [r["tableName"] for r in spark.sql(f"SHOW TABLES IN `{database}` LIKE '{table}{MARK}*'").collect()]
    return sorted(int(n.removeprefix(table + MARK)) for n in names)


def new_version(
    spark: SparkSession,
    database: str,
    table: str,
    columns: str,
    warehouse: str,
    partitioned_by: str | None = None,
    buckets: tuple[str, int] | None = None,
) -> str:
    """Declare the next version, empty, in a folder of its own; returns the name of its table."""
    name = f"{table}{MARK}{max(numbers(spark, database, table), default=0) + 1}"
    location = f"{warehouse}/{table}-{uuid.uuid4().hex}"
    catalog.recreate_table(spark, database, name, columns, location, partitioned_by, buckets=buckets)
    return name


def adopt(spark: SparkSession, database: str, table: str) -> str | None:
    """The published version of a table; None when there is no such table.

    A plain table of this name, as loads made before there were versions, becomes the oldest version; only
    then is there a moment without a table.
    """
    version = catalog.version_table(spark, database, table)
    if version is None and catalog.table_exists(spark, database, table):
        version = f"{table}{MARK}0"
        name = catalog.qualified(database, table)
        spark.sql(f"ALTER TABLE {name} RENAME TO {catalog.qualified(database, version)}")
        publish(spark, database, table, version)
    return version


def publish(spark: SparkSession, database: str, table: str, version: str) -> None:
    """Make ``version`` what readers of the table see, in one statement."""
    spark.sql(
        f"CREATE OR REPLACE VIEW {catalog.qualified(database, table)} "
        f"TBLPROPERTIES ('{catalog.VERSION}' = '{version}') "
        f"AS SELECT * FROM {catalog.qualified(database, version)}"
    )


def folders(spark: SparkSession, database: str, version: str) -> list[str]:
    """Folders with files of a version: its partitions, or its own location."""
    return sorted({f.rpartition("/")[0] for f in spark.table(catalog.qualified(database, version)).inputFiles()})


def take_over(
    spark: SparkSession, database: str, version: str, before: str, column: str, wanted: Callable[[str], bool]
) -> None:
    """Give ``version`` the partitions of ``before`` whose value of ``column`` is ``wanted``; no row is read."""
    found = []
    for folder in folders(spark, database, before):
        value = folder.rpartition("/")[2].removeprefix(f"{column}=")
        if wanted(value):
            found.append(f"PARTITION ({column} = '{value}') LOCATION '{folder}'")
    for at in range(0, len(found), ADDED_AT_ONCE):
        added = " ".join(found[at : at + ADDED_AT_ONCE])
        spark.sql(f"ALTER TABLE {catalog.qualified(database, version)} ADD IF NOT EXISTS {added}")


def release(spark: SparkSession, database: str, table: str, warehouse: str, keep: int = 1) -> None:
    """Forget all but the published version and the ``keep - 1`` before it, and delete what none of them uses."""
    live = catalog.version_table(spark, database, table)
    if live is None:
        return
    newest = int(live.removeprefix(table + MARK))
    older = [n for n in numbers(spark, database, table) if n < newest]
    kept = [newest, *older[len(older) - keep + 1 :]] if keep > 1 else [newest]
    for number in set(numbers(spark, database, table)) - set(kept):
        catalog.drop_table(spark, database, f"{table}{MARK}{number}")
    # Folders by what follows the warehouse, as a path may come with or without a scheme.
    used = set()
    for number in kept:
        version = f"{table}{MARK}{number}"
        places = [catalog.table_location(spark, database, version), *folders(spark, database, version)]
        used |= {p.rstrip("/").rpartition(f"/{table}-")[2] for p in places}
    for name in folder_names(spark, warehouse):
        if not name.startswith(f"{table}-"):
            continue
        own = name.removeprefix(f"{table}-")
        inside = {u for u in used if u.startswith(f"{own}/")}
        if own not in used and not inside:
            delete_folder(spark, f"{warehouse}/{name}")
            continue
        for part in folder_names(spark, f"{warehouse}/{name}"):
            if "=" in part and f"{own}/{part}" not in inside:
                delete_folder(spark, f"{warehouse}/{name}/{part}")
