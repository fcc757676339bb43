"""Checks on a table before or after it is published."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F


def quality_counts(
    df: DataFrame, required: Sequence[str] = (), widths: Mapping[str, int] | None = None
) -> DataFrame:
    """One row of counts in one pass: rows, complete rows, NULLs and over-wide values."""
    missing = [F.col(c).isNull() for c in required]
    complete = F.lit(True)
    for gap in missing:
        complete = complete & ~gap
    return df.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(complete).alias("rows_accepted"),
        *[F.count_if(gap).alias(f"{c}_missing") for c, gap in zip(required, missing)],
        *[
            F.count_if(F.length(c) > width).alias(f"{c}_too_wide")
            for c, width in (widths or {}).items()
        ],
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str], name: str = "copies") -> DataFrame:
    """Keys held by more than one row; empty when ``keys`` identify the rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).where(F.col(name) > 1)


def too_wide(df: DataFrame, widths: Mapping[str, int]) -> DataFrame:
    """Rows with at least one text longer than its column allows."""
    over = F.lit(False)
    for column, width in widths.items():
        over = over | F.coalesce(F.length(column) > width, F.lit(False))
    return df.where(over)
