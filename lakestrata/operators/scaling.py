"""Min-max scaling within groups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F

from lakestrata.layout import materialize


def group_bounds(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Smallest and largest value per group."""
    return df.groupBy(*by).agg(F.min(value).alias("low"), F.max(value).alias("high"))


def minmax_normalize(df: DataFrame, value: str, by: Sequence[str], name: str) -> DataFrame:
    """Add ``(value - low) / (high - low)`` within the group, 0.0 where it has no spread.

    A window would send a whole group to one task. Here the bounds, one row per
    group, are aggregated and written first; the rows meet them in a broadcast
    join when the written bounds are small, without being shuffled at all, and
    in a skew-splitting sort-merge join when there are very many groups. Groups
    are matched NULL-safely, as a window would do.
    """
    return scale_between(df, materialize(group_bounds(df, by, value), "bounds"), value, by, name)


def scale_between(df: DataFrame, bounds: DataFrame, value: str, by: Sequence[str], name: str) -> DataFrame:
    """The same with given ``bounds``, one row (by, low, high) per group of ``df``."""
    same_group = reduce(and_, [F.col(f"row.{k}").eqNullSafe(F.col(f"bound.{k}")) for k in by])
    spread = F.col("bound.high") - F.col("bound.low")
    scaled = (
        F.when(spread != 0, (F.col(f"row.{value}") - F.col("bound.low")) / spread)
        .otherwise(F.lit(0.0))
        .alias(name)
    )
    return df.alias("row").join(bounds.alias("bound"), same_group).select("row.*", scaled)
