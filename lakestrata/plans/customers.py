"""Customers: cumulative CSV dumps -> bronze text -> silver, newest record per client."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from lakestrata import schemas
from lakestrata.functions import (
    FOLDER_DAY,
    blank_to_null,
    normalize_email,
    parse_day,
    parse_int,
)
from lakestrata.layout import Layout, folder_exists, materialize, restore_folder, swap_folder
from lakestrata.operators import (
    REJECT_REASON,
    accepted_rows,
    keep_latest,
    mark_rejects,
    rejected_rows,
    trim_strings,
)
from lakestrata.sinks import observed, write_parquet
from lakestrata.sources import (
    SOURCE_FILE,
    read_csv_text,
    read_parquet,
    source_folder,
    with_source_file,
)

BRONZE = f"{schemas.RAW_CUSTOMERS}, {SOURCE_FILE} STRING"
DUMP_DAY = "_dump_day"
# Where a silver row is from, newest last; kept beside silver, under ORIGINS.
ORIGIN = [DUMP_DAY, SOURCE_FILE]
ORIGINS = "customers_origins"
ORIGIN_SCHEMA = f"client_id INT, {DUMP_DAY} DATE, {SOURCE_FILE} STRING"
SILVER_COLUMNS = [c.split()[0] for c in schemas.SILVER_CUSTOMERS.split(", ")]


def dump_day(source_file: Column) -> Column:
    """The day in the name of the folder a file lies in."""
    return parse_day(source_folder(source_file), FOLDER_DAY)


def bronze_customers(raw: DataFrame) -> DataFrame:
    """Raw text, trimmed, with the file it came from. ``raw`` must be a file scan."""
    return trim_strings(with_source_file(raw), skip=[SOURCE_FILE])


def typed_customers(bronze: DataFrame) -> DataFrame:
    """Typed rows with the day of their dump and the reason a row is left out, if any.

    Keys are tested after cleaning, so blank addresses do not pass as values.
    """
    typed = bronze.select(
        parse_int(F.col("ClientId")).alias("client_id"),
        blank_to_null(F.col("FirstName")).alias("first_name"),
        blank_to_null(F.col("LastName")).alias("last_name"),
        normalize_email(F.col("Email")).alias("email"),
        parse_day(F.trim("RegistrationDate")).alias("registration_date"),
        blank_to_null(F.col("State")).alias("state"),
        dump_day(F.col(SOURCE_FILE)).alias(DUMP_DAY),
        SOURCE_FILE,
    )
    return mark_rejects(
        typed,
        {"bad client_id": F.col("client_id").isNull(), "no email": F.col("email").isNull()},
    )


def dated_customers(bronze: DataFrame) -> DataFrame:
    """One row per client, from the newest dump that holds the client, with its origin."""
    return keep_latest(accepted_rows(typed_customers(bronze)), ["client_id"], ORIGIN)


def silver_customers(bronze: DataFrame) -> DataFrame:
    """Typed, one row per client: the one from the newest dump that holds the client."""
    return dated_customers(bronze).drop(*ORIGIN)


def rejected_customers(bronze: DataFrame) -> DataFrame:
    return rejected_rows(typed_customers(bronze))


def raw_to_bronze(spark: SparkSession, lake: Layout) -> None:
    raw = read_csv_text(spark, lake.raw("customers/*/*.csv"), schemas.RAW_CUSTOMERS)
    write_parquet(bronze_customers(raw), lake.bronze("customers"))


def bronze_to_silver(spark: SparkSession, lake: Layout) -> Observation:
    """Rewrite all of silver; returns ``rows_in`` and ``rows_accepted`` of the pass.

    The origin of each row is kept beside silver for dumps that come later.
    """
    marked = typed_customers(read_parquet(spark, lake.bronze("customers"), BRONZE))
    counted, counts = observed(
        marked,
        "silver_customers",
        rows_in=F.count(F.lit(1)),
        rows_accepted=F.count_if(F.col(REJECT_REASON).isNull()),
    )
    publish(spark, lake, keep_latest(accepted_rows(counted), ["client_id"], ORIGIN))
    return counts


def publish(spark: SparkSession, lake: Layout, dated: DataFrame) -> None:
    """Put complete rows in the place of silver, and their origins beside it.

    Both are written first and then swapped in, origins before rows: a run that
    dies in between is mended by applying its dump again.
    """
    whole = materialize(dated, "customers")
    for name, columns in ((ORIGINS, ["client_id", *ORIGIN]), ("customers", SILVER_COLUMNS)):
        ready = lake.silver(f"{name}.ready")
        write_parquet(whole.select(*columns), ready)
        swap_folder(spark, ready, lake.silver(name))


def apply_dump(spark: SparkSession, lake: Layout, dump: str) -> None:
    """Merge one new dump folder into silver instead of reading all dumps again.

    A client of the dump replaces its silver row unless that came from a newer
    dump, and clients the dump lacks stay. So dumps may come late, in any order and
    twice, and give what a rebuild from all of them gives. Rows of unknown origin
    count as oldest. Without silver the dump is the first.
    """
    raw = read_csv_text(spark, lake.raw(f"customers/{dump}/*.csv"), schemas.RAW_CUSTOMERS)
    changes = dated_customers(bronze_customers(raw))
    for name in (ORIGINS, "customers"):
        restore_folder(spark, lake.silver(name))
    if folder_exists(spark, lake.silver("customers")):
        known = read_parquet(spark, lake.silver("customers"), schemas.SILVER_CUSTOMERS)
        if folder_exists(spark, lake.silver(ORIGINS)):
            origins = read_parquet(spark, lake.silver(ORIGINS), ORIGIN_SCHEMA)
        else:
            origins = spark.createDataFrame([], ORIGIN_SCHEMA)
        dated = known.join(origins, "client_id", "left").select(*changes.columns)
        changes = keep_latest(dated.unionByName(changes), ["client_id"], ORIGIN)
    publish(spark, lake, changes)
