"""The daily sales steps as file streams run to completion (``availableNow``).

The batch steps rewrite whole tables each day. These give the same tables from
the new files alone: progress is kept beside the lake, and the file sink's log
makes every file count once even when a run dies halfway. Both steps are
row-local, so there is no state and no late-data question. Use either the batch
or the incremental steps on one lake, not both, as the sink log lists the files
that make up the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakestrata import schemas
from lakestrata.layout import Layout
from lakestrata.plans.sales import BRONZE, BRONZE_DAY, bronze_by_day, bronze_sales, silver_sales


def _drain(rows: DataFrame, lake: Layout, name: str, path: str, by: str | None = None) -> None:
    writer = (
        rows.writeStream.format("parquet")
        .option("checkpointLocation", lake.path("progress", name))
        .trigger(availableNow=True)
    )
    if by is not None:
        writer = writer.partitionBy(by)
    writer.start(path).awaitTermination()


def ingest_new_sales(spark: SparkSession, lake: Layout, files_per_batch: int = 10_000) -> None:
    """Append the raw sales files not yet seen to bronze.

    A large backlog is worked off in batches, so a run that dies repeats one
    batch and not everything.
    """
    arrivals = (
        spark.readStream.schema(schemas.RAW_SALES)
        .options(header=True, mode="PERMISSIVE", maxFilesPerTrigger=files_per_batch)
        .csv(lake.raw("sales/*/*.csv"))
    )
    rows = bronze_by_day(bronze_sales(arrivals))
    _drain(rows, lake, "bronze-sales", lake.bronze("sales"), by=BRONZE_DAY)


def refine_new_sales(spark: SparkSession, lake: Layout, files_per_batch: int = 10_000) -> None:
    """Append the bronze rows not yet seen to silver, one folder per purchase day."""
    arrivals = (
        spark.readStream.schema(BRONZE)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(lake.bronze("sales"))
    )
    _drain(
        silver_sales(arrivals), lake, "silver-sales", lake.silver("sales"), by="purchase_date"
    )
