"""Gold: catalogued silver tables, customers enriched from profiles, and the loaded tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Collection

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakestrata import catalog, publishing, schemas
from lakestrata.functions import blank_to_null, normalize_email, split_full_name
from lakestrata.layout import Layout
from lakestrata.operators import duplicate_keys, left_fill, too_wide
from lakestrata.sinks import observed, write_parquet
from lakestrata.sources import read_days, read_parquet, read_partition_range, read_table

# Which side a filled column prefers.
PROFILE_FILLS = {
    "first_name": ("left.first_name", "right.first_name"),
    "last_name": ("left.last_name", "right.last_name"),
    "state": ("right.state", "left.state"),
}
CARRIED = ("birth_date", "age", "phone_number")


def register_silver(spark: SparkSession, lake: Layout, database: str = "silver") -> None:
    """Declare the silver directories as tables; safe to repeat."""
    catalog.create_database(spark, database, lake.warehouse(database))
    for table, columns in (
        ("customers", schemas.SILVER_CUSTOMERS),
        ("user_profiles", schemas.SILVER_PROFILES),
    ):
        catalog.recreate_table(spark, database, table, columns, lake.silver(table))


def enrich_customers(
    customers: DataFrame,
    profiles: DataFrame,
    as_of: Column | None = None,
    *,
    name_policy: str = "split",
    profiles_are_unique: bool = False,
) -> DataFrame:
    """Every customer once, gaps filled from the profile with the same address.

    ``name_policy="split"`` fills first and last name from the two parts of the
    profile's full name; ``"verbatim"`` fills the first name with the whole of
    it and leaves the last name alone.
    """
    if name_policy == "split":
        first_name, last_name = split_full_name(F.col("full_name"))
    elif name_policy == "verbatim":
        first_name, last_name = blank_to_null(F.col("full_name")), F.lit(None).cast("string")
    else:
        raise ValueError(f"unknown name_policy: {name_policy}")

    left = customers.select(
        "client_id",
        blank_to_null(F.col("first_name")).alias("first_name"),
        blank_to_null(F.col("last_name")).alias("last_name"),
        normalize_email(F.col("email")).alias("email"),
        F.col("registration_date").cast("date").alias("registration_date"),
        blank_to_null(F.col("state")).alias("state"),
    )
    right = profiles.select(
        normalize_email(F.col("email")).alias("email"),
        first_name.alias("first_name"),
        last_name.alias("last_name"),
        "birth_date",
        "age",
        blank_to_null(F.col("state")).alias("state"),
        blank_to_null(F.col("phone_number")).alias("phone_number"),
    )
    filled = left_fill(
        left, right, "email", PROFILE_FILLS, CARRIED, right_is_unique=profiles_are_unique
    )
    stamp = F.current_timestamp() if as_of is None else as_of.cast("timestamp")
    return filled.withColumn("updated_at", stamp)


def silver_to_gold(
    spark: SparkSession,
    lake: Layout,
    as_of: Column | None = None,
    database: str = "silver",
    name_policy: str = "split",
) -> None:
    enriched = enrich_customers(
        read_table(spark, database, "customers"),
        read_table(spark, database, "user_profiles"),
        as_of,
        name_policy=name_policy,
        profiles_are_unique=True,  # silver is written one row per address
    )
    write_parquet(enriched, lake.gold("user_profiles_enriched"))


def check_gold_profiles(rows: DataFrame) -> None:
    """Refuse rows that share a client_id or hold a text too long for its column."""
    copies = duplicate_keys(rows, ["client_id"]).limit(5).collect()
    if copies:
        raise ValueError(f"client_id is not unique: {[r['client_id'] for r in copies]}")
    wide = too_wide(rows, schemas.GOLD_PROFILE_WIDTHS).limit(5).collect()
    if wide:
        raise ValueError(f"texts are too long for gold: client_id {[r['client_id'] for r in wide]}")


def load_gold_profiles(spark: SparkSession, lake: Layout, database: str = "gold", keep: int = 1) -> int:
    """Load the whole enriched directory into the typed table; returns the row count.

    Fails before the table is touched when client_id is no key or a text is too long. Readers see the old
    rows until the new ones are complete and counted. ``keep`` versions stay for reads that began before.
    """
    rows = read_parquet(spark, lake.gold("user_profiles_enriched"))
    check_gold_profiles(rows)
    warehouse = lake.warehouse(database)
    catalog.create_database(spark, database, warehouse)
    table = "user_profiles_enriched"
    publishing.adopt(spark, database, table)
    version = publishing.new_version(spark, database, table, schemas.GOLD_PROFILES, warehouse)
    counted, counts = observed(rows, "gold_profiles")
    catalog.insert_by_name(counted, database, version, overwrite=True)
    found = reconcile(counts.get["rows"], read_table(spark, database, version))
    publishing.publish(spark, database, table, version)
    publishing.release(spark, database, table, warehouse, keep)
    return found


def load_gold_sales(
    spark: SparkSession,
    lake: Layout,
    first: dt.date,
    last: dt.date,
    database: str = "gold",
    *,
    append: bool = False,
    keep: int = 1,
) -> int:
    """Load silver days ``first`` to ``last`` into the typed sales table.

    The whole range is one insert, one folder per day, into a new version that readers see once it is
    complete and counted. A fresh load holds these days only. ``append`` takes the other days over
    from the version before, where they lie; days loaded again replace themselves, and days of the range that
    have no rows any more are gone. Folders that no kept version uses are deleted.
    """
    chosen = read_partition_range(
        spark, lake.silver("sales"), "purchase_date", first, last, schemas.SILVER_SALES
    )
    others = (lambda day: not str(first) <= day <= str(last)) if append else None
    return _load_sales_version(spark, lake, chosen, others, database, keep)


def reload_gold_days(
    spark: SparkSession, lake: Layout, days: Collection[dt.date], database: str = "gold", keep: int = 1
) -> int:
    """Load the given silver days anew into the sales table; all its other days stay where they lie."""
    chosen = read_days(spark, lake.silver("sales"), "purchase_date", days, schemas.SILVER_SALES)
    loaded = {str(day) for day in days}
    return _load_sales_version(spark, lake, chosen, lambda day: day not in loaded, database, keep)


def _load_sales_version(
    spark: SparkSession,
    lake: Layout,
    chosen: DataFrame,
    others: Callable[[str], bool] | None,
    database: str,
    keep: int,
) -> int:
    warehouse = lake.warehouse(database)
    catalog.create_database(spark, database, warehouse)
    counted, counts = observed(chosen, "gold_sales")
    before = publishing.adopt(spark, database, "sales")
    version = publishing.new_version(
        spark, database, "sales", schemas.GOLD_SALES, warehouse, "purchase_date"
    )
    # Silver files hold one day each, so writing by day needs no shuffle.
    catalog.insert_by_name(counted, database, version, overwrite=True)
    found = reconcile(counts.get["rows"], read_table(spark, database, version))
    if others and before:
        publishing.take_over(spark, database, version, before, "purchase_date", others)
    publishing.publish(spark, database, "sales", version)
    publishing.release(spark, database, "sales", warehouse, keep)
    return found


def reconcile(written: int, loaded: DataFrame) -> int:
    """Fail when a load lost or repeated rows."""
    found = loaded.count()
    if found != written:
        raise RuntimeError(f"wrote {written} rows but the table holds {found}")
    return found
