"""User profiles: JSON Lines -> bronze -> silver, one row per e-mail address."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from lakestrata import schemas
from lakestrata.functions import (
    STRICT_DAY,
    blank_to_null,
    completed_years,
    normalize_email,
    parse_day,
)
from lakestrata.layout import Layout
from lakestrata.operators import (
    REJECT_REASON,
    accepted_rows,
    drop_duplicate_keys,
    mark_rejects,
    rejected_rows,
)
from lakestrata.sinks import observed, write_parquet
from lakestrata.sources import SOURCE_FILE, read_parquet, with_source_file

LINE, MALFORMED = "_line", "_malformed"
BRONZE = f"{schemas.RAW_PROFILES}, {SOURCE_FILE} STRING, {LINE} STRING, {MALFORMED} BOOLEAN"


def bronze_profiles(raw: DataFrame) -> DataFrame:
    """Raw columns with the file each row came from. ``raw`` must be a file scan."""
    return with_source_file(raw)


def bronze_from_lines(lines: DataFrame) -> DataFrame:
    """The known fields of each JSON line beside the line itself.

    The line keeps fields not asked for today, and lines that cannot be parsed;
    ``_malformed`` tells these. ``lines`` must be a text file scan.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    parsed = F.from_json("value", f"{schemas.RAW_PROFILES}, _corrupt STRING", options)
    known = [F.col(f"_json.{c.split()[0]}") for c in schemas.RAW_PROFILES.split(", ")]
    rows = with_source_file(lines).where(F.trim("value") != "").withColumn("_json", parsed)
    return rows.select(
        *known, SOURCE_FILE, F.col("value").alias(LINE), F.col("_json._corrupt").isNotNull().alias(MALFORMED)
    )


def typed_profiles(bronze: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Typed rows and the reason a row is left out, if any."""
    born = parse_day(F.col("birth_date"), STRICT_DAY)
    malformed = F.col(MALFORMED) if MALFORMED in bronze.columns else F.lit(False)
    typed = bronze.select(
        normalize_email(F.col("email")).alias("email"),
        blank_to_null(F.col("full_name")).alias("full_name"),
        born.alias("birth_date"),
        completed_years(born, F.current_date() if as_of is None else as_of).alias("age"),
        blank_to_null(F.col("state")).alias("state"),
        blank_to_null(F.col("phone_number")).alias("phone_number"),
        malformed.alias(MALFORMED),
    )
    reasons = {"malformed line": F.col(MALFORMED), "no email": F.col("email").isNull()}
    return mark_rejects(typed, reasons).drop(MALFORMED)


def silver_profiles(bronze: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Typed and unique by address; ``age`` in completed years on ``as_of`` (today if None)."""
    return drop_duplicate_keys(accepted_rows(typed_profiles(bronze, as_of)), ["email"])


def rejected_profiles(bronze: DataFrame) -> DataFrame:
    return rejected_rows(typed_profiles(bronze))


def raw_to_bronze(spark: SparkSession, lake: Layout) -> None:
    lines = spark.read.text(lake.raw("user_profiles/*.json"))
    write_parquet(bronze_from_lines(lines), lake.bronze("user_profiles"))


def bronze_to_silver(
    spark: SparkSession, lake: Layout, as_of: Column | None = None
) -> Observation:
    """Rewrite all of silver; returns ``rows_in`` and ``rows_accepted`` of the pass."""
    marked = typed_profiles(read_parquet(spark, lake.bronze("user_profiles"), BRONZE), as_of)
    counted, counts = observed(
        marked,
        "silver_profiles",
        rows_in=F.count(F.lit(1)),
        rows_accepted=F.count_if(F.col(REJECT_REASON).isNull()),
    )
    write_parquet(
        drop_duplicate_keys(accepted_rows(counted), ["email"]), lake.silver("user_profiles")
    )
    return counts
