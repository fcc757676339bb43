"""A run that works off what changed since the last one, from delivered files to the loaded tables.

Each source has a manifest of the files taken in, written after their rows were. A run that dies repeats
what it had not finished; a run without new files writes nothing. A late or corrected sales file
touches the bronze files that hold its days, the silver folders of these days and their partitions in gold.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, SparkSession, functions as F

from lakestrata import catalog, commits, schemas
from lakestrata.layout import (
    Layout,
    create_file,
    delete_folder,
    folder_exists,
    folder_names,
    materialize,
    read_file,
)
from lakestrata.plans import customers, gold, profiles, sales
from lakestrata.sources import SOURCE_FILE, read_csv_text
from lakestrata.sources.deliveries import Changes, changes_since, remember

PATTERNS = {
    "sales": "sales/*/*.csv",
    "customers": "customers/*/*.csv",
    "user_profiles": "user_profiles/*.json",
}


@dataclass
class Done:
    """What a run did. ``sales_days`` is None when all days were rebuilt."""

    sales_days: set[dt.date] | None = field(default_factory=set)
    customers: bool = False
    profiles: bool = False
    gold_profiles: bool = False
    gold_sales: bool = False


def manifest(lake: Layout, source: str) -> str:
    return lake.path("manifests", source)


def changes_of(spark: SparkSession, lake: Layout, source: str) -> Changes:
    return changes_since(spark, manifest(lake, source), lake.raw(PATTERNS[source]), source)


def update_sales(spark: SparkSession, lake: Layout) -> set[dt.date] | None:
    """Take in new, replaced and removed sales files; returns the days of silver that were rebuilt, None for all.

    The days are noted before bronze changes, so a run that died after that is made up for by the next.
    """
    changes, notes = changes_of(spark, lake, "sales"), lake.path("manifests", "sales-replay.due")
    noted = folder_names(spark, notes)
    if not changes and not noted:
        return set()
    if changes.everything or commits.latest(spark, lake.bronze("sales")) is None:
        sales.raw_to_bronze(spark, lake)
        sales.bronze_to_silver(spark, lake)
        days = None
    else:
        days = {dt.date.fromisoformat(day) for note in noted for day in read_file(spark, f"{notes}/{note}").split()}
        if changes:
            days |= replace_files(spark, lake, changes, f"{notes}/{uuid.uuid4().hex}")
        sales.replay_days(spark, lake, sorted(days))
    remember(spark, manifest(lake, "sales"), changes)
    delete_folder(spark, notes)
    return days


def replace_files(spark: SparkSession, lake: Layout, changes: Changes, note: str) -> set[dt.date]:
    """Put the rows of added files into bronze and take those of dropped ones out, in one version.

    Returns the days either had rows of, which are also written to the file ``note`` before. Bronze files without a row of a dropped file stay; to find them, one column
    of bronze is read, and only when files were dropped.
    """
    root = lake.bronze("sales")
    day = F.col(sales.BRONZE_DAY)
    if changes.added:
        raw = read_csv_text(spark, sorted(changes.added), schemas.RAW_SALES)
        rows = materialize(sales.bronze_by_day(sales.bronze_sales(raw)), "arrived-sales")
    else:
        rows = spark.createDataFrame([], sales.BRONZE)
    touched = rows.select(day.alias("day"))
    holders = None
    before = commits.latest(spark, root)
    if changes.dropped and commits.runs_of(spark, before):
        dropped = spark.createDataFrame([(path,) for path in changes.dropped], f"{SOURCE_FILE} STRING")
        bronze = sales.read_bronze(spark, lake)
        path = F.split("_metadata.file_path", "/")
        placed = bronze.select(
            SOURCE_FILE,
            day.alias("day"),
            F.element_at(path, -1).alias("file"),
            F.replace(F.element_at(path, -2), F.lit("run=")).alias("run"),
        )
        void = materialize(placed.join(F.broadcast(dropped), SOURCE_FILE, "left_semi").drop(SOURCE_FILE).distinct(), "void-sales")
        touched = touched.unionByName(void.select("day"))
        holders = void.select("run", "file").distinct()
        # One row per bronze file that holds rows of a changed file.
        files = [f"{root}/run={r['run']}/{r['file']}" for r in holders.collect()]
        if files:
            others = spark.read.schema(sales.BRONZE).parquet(*files).join(F.broadcast(dropped), SOURCE_FILE, "left_anti")
            rows = rows.unionByName(others.select(*rows.columns))
    # One row per day that changed.
    days = {r["day"] for r in touched.where("day IS NOT NULL").distinct().collect()}
    create_file(spark, note, " ".join(map(str, sorted(days))))
    commits.commit(rows, root, sales.BRONZE_DAY, append=True, without=holders)
    commits.release(spark, root)
    return days


def update_customers(spark: SparkSession, lake: Layout) -> bool:
    """Merge new dumps, or rebuild from all when a file of a known dump changed; tells whether there was anything to do."""
    changes = changes_of(spark, lake, "customers")
    if not changes:
        return False
    if changes.everything or changes.dropped:
        customers.raw_to_bronze(spark, lake)
        customers.bronze_to_silver(spark, lake)
    else:
        for dump in sorted({path.split("/")[-2] for path in changes.added}):
            customers.apply_dump(spark, lake, dump)
    remember(spark, manifest(lake, "customers"), changes)
    return True


def update_profiles(spark: SparkSession, lake: Layout, as_of: Column | None = None) -> bool:
    """Rebuild the profiles when a file of them changed; tells whether one did."""
    changes = changes_of(spark, lake, "user_profiles")
    if not changes:
        return False
    profiles.raw_to_bronze(spark, lake)
    profiles.bronze_to_silver(spark, lake, as_of)
    remember(spark, manifest(lake, "user_profiles"), changes)
    return True


def _due(spark: SparkSession, lake: Layout, step: str) -> str:
    """A note that a step behind the sources is still to be done, kept until it is."""
    return lake.path("manifests", f"{step}.due")


def _note(spark: SparkSession, lake: Layout, step: str) -> None:
    if not folder_exists(spark, _due(spark, lake, step)):
        create_file(spark, _due(spark, lake, step), "")


def _loaded_range(spark: SparkSession, lake: Layout, database: str) -> str:
    return lake.path("manifests", f"{database}-sales.range")


def update_gold_sales(
    spark: SparkSession, lake: Layout, days: set[dt.date] | None, first: dt.date, last: dt.date, database: str
) -> bool:
    """Load the changed days of the range into gold, or all of it when the range is another than before."""
    noted, wanted = _loaded_range(spark, lake, database), f"{first} {last}"
    known = folder_exists(spark, noted) and read_file(spark, noted) == wanted
    if not known or days is None or not catalog.table_exists(spark, database, "sales"):
        delete_folder(spark, noted)
        gold.load_gold_sales(spark, lake, first, last, database)
        create_file(spark, noted, wanted)
        return True
    inside = {day for day in days if first <= day <= last}
    if inside:
        gold.reload_gold_days(spark, lake, inside, database)
    return bool(inside)


def run_changed(
    spark: SparkSession,
    lake: Layout,
    first: dt.date,
    last: dt.date,
    as_of: Column | None = None,
    silver: str = "silver",
    gold_db: str = "gold",
) -> Done:
    """Bring all tables up to date with the delivered files; ``first`` to ``last`` is the range of sales in gold.

    Gives what a whole run would, but for ages and stamps: profiles keep those of the day they were last
    rebuilt. Days whose gold load a run that died left undone are worked off by the next.
    """
    done = Done()
    if changes_of(spark, lake, "customers") or changes_of(spark, lake, "user_profiles"):
        _note(spark, lake, "enrich")
    done.customers = update_customers(spark, lake)
    done.profiles = update_profiles(spark, lake, as_of)
    if folder_exists(spark, _due(spark, lake, "enrich")):
        gold.register_silver(spark, lake, silver)
        gold.silver_to_gold(spark, lake, as_of, silver)
        gold.load_gold_profiles(spark, lake, gold_db)
        delete_folder(spark, _due(spark, lake, "enrich"))
        done.gold_profiles = True
    # Steps that follow a source are noted before it changes, so that a run that dies in between loads all of the range next time.
    unfinished = folder_exists(spark, _due(spark, lake, "load-sales"))
    if not unfinished and changes_of(spark, lake, "sales"):
        _note(spark, lake, "load-sales")
    done.sales_days = update_sales(spark, lake)
    days = None if unfinished else done.sales_days
    done.gold_sales = update_gold_sales(spark, lake, days, first, last, gold_db)
    delete_folder(spark, _due(spark, lake, "load-sales"))
    return done
