"""Sales: dated CSV folders -> bronze text, clustered by purchase day -> silver typed, one folder per day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from lakestrata import commits, schemas
from lakestrata.functions import parse_day, parse_int, parse_money
from lakestrata.layout import Layout, delete_folder
from lakestrata.operators import (
    REJECT_REASON,
    accepted_rows,
    mark_rejects,
    rejected_rows,
    trim_strings,
)
from lakestrata.sinks import observed, write_partitioned
from lakestrata.sources import SOURCE_FILE, read_csv_text, read_parquet, with_source_file

BRONZE_DAY = "purchase_day"
BRONZE = f"{schemas.RAW_SALES}, {SOURCE_FILE} STRING, {BRONZE_DAY} DATE"


def bronze_sales(raw: DataFrame) -> DataFrame:
    """Raw text, trimmed, with the file it came from. ``raw`` must be a file scan."""
    return trim_strings(with_source_file(raw), skip=[SOURCE_FILE])


def bronze_by_day(bronze: DataFrame) -> DataFrame:
    """Adds the day that bronze is clustered by; NULL where the text is no day."""
    return bronze.withColumn(BRONZE_DAY, parse_day(F.trim("PurchaseDate")))


def typed_sales(bronze: DataFrame) -> DataFrame:
    """Typed columns plus the reason a row cannot be accepted, if any."""
    typed = bronze.select(
        F.trim("Product").alias("product_name"),
        parse_int(F.col("CustomerId")).alias("client_id"),
        parse_money(F.col("Price")).alias("price"),
        parse_day(F.trim("PurchaseDate")).alias("purchase_date"),
    )
    return mark_rejects(
        typed,
        {
            "bad client_id": F.col("client_id").isNull(),
            "bad purchase_date": F.col("purchase_date").isNull(),
            "bad price": F.col("price").isNull(),
        },
    )


def silver_sales(bronze: DataFrame) -> DataFrame:
    return accepted_rows(typed_sales(bronze))


def rejected_sales(bronze: DataFrame) -> DataFrame:
    return rejected_rows(typed_sales(bronze))


def read_bronze(spark: SparkSession, lake: Layout, days: Sequence[dt.date] | None = None) -> DataFrame:
    """Bronze rows, or those of some purchase days, read from the files that hold them.

    A bronze that was filled by increments has no commit list; there the days only prune
    its folders and row groups.
    """
    root = lake.bronze("sales")
    if commits.latest(spark, root):
        return commits.read_committed(spark, root, BRONZE, BRONZE_DAY, days)
    rows = read_parquet(spark, root, BRONZE)
    return rows if days is None else rows.where(F.col(BRONZE_DAY).isin(list(days)))


def raw_to_bronze(spark: SparkSession, lake: Layout) -> Observation:
    """Rewrite all of bronze; returns ``rows`` of the pass.

    One write whatever the number of days: rows are clustered by purchase day, and the commit list
    tells which files hold a day. The day is that of the purchase and not that of the delivery, so a
    replay finds late rows without reading other days.
    """
    raw = read_csv_text(spark, lake.raw("sales/*/*.csv"), schemas.RAW_SALES)
    counted, counts = observed(bronze_by_day(bronze_sales(raw)), "bronze_sales")
    commits.commit(counted, lake.bronze("sales"), BRONZE_DAY)
    commits.release(spark, lake.bronze("sales"))
    return counts


def bronze_to_silver(spark: SparkSession, lake: Layout) -> Observation:
    """Rewrite all of silver; returns ``rows_in`` and ``rows_accepted`` of the pass.

    Rows of one run lie together by day, so its files become day folders without a shuffle.
    """
    marked = typed_sales(read_bronze(spark, lake))
    counted, counts = observed(
        marked,
        "silver_sales",
        rows_in=F.count(F.lit(1)),
        rows_accepted=F.count_if(F.col(REJECT_REASON).isNull()),
    )
    version = commits.latest(spark, lake.bronze("sales"))
    together = version is not None and len(commits.runs_of(spark, version)) == 1
    write_partitioned(accepted_rows(counted), lake.silver("sales"), "purchase_date", as_is=together)
    return counts


def replay_days(spark: SparkSession, lake: Layout, days: Sequence[dt.date]) -> None:
    """Rebuild only the given purchase days of silver; other days stay untouched.

    Only the bronze files that hold these days are read. Days with rows replace their
    folders; the folders of days that no longer have any are removed after that.
    """
    if not days:
        return
    path = lake.silver("sales")
    silver = silver_sales(read_bronze(spark, lake, sorted(set(days))))
    write_partitioned(silver, path, "purchase_date", replay=True)
    # One row per given day at most.
    present = {r[0] for r in silver.select("purchase_date").distinct().collect()}
    for day in set(days) - present:
        delete_folder(spark, f"{path}/purchase_date={day}")
