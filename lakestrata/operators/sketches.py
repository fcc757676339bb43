"""Statistics that merge: sketches kept per group and day, added up for any range of days.

A quantile sketch is exact while a group has fewer than ``QUANTILE_SIZE`` values. Beyond that a quantile is off in rank by
at most ``RANK_ERROR`` in 99 of 100 cases, however many sketches were merged. A distinct sketch is exact
below ``DISTINCT_SIZE`` values and has a standard error of one in its square root beyond. The exact forms
are :func:`median_by` and :func:`distinct_count_by`, which need the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

QUANTILE_SIZE = 1000
RANK_ERROR = 0.003
LOG_DISTINCT_SIZE = 12
DISTINCT_SIZE = 1 << LOG_DISTINCT_SIZE

SKETCHES = ("rows", "values", "total", "quantiles", "distinct")


def sketch_by(df: DataFrame, keys: Sequence[str], value: str, distinct: str) -> DataFrame:
    """Per group: rows, values that are not NULL and their sum, and sketches of ``value`` and of the distinct ``distinct``.

    Every task sketches its own rows, so a hot group costs one sketch per task.
    """
    number = F.col(value).cast("double")
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(value).alias("values"),
        F.sum(number).alias("total"),
        F.kll_sketch_agg_double(number, F.lit(QUANTILE_SIZE)).alias("quantiles"),
        F.theta_sketch_agg(F.col(distinct), F.lit(LOG_DISTINCT_SIZE)).alias("distinct"),
    )


def merge_sketches(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Groups of :func:`sketch_by` merged into larger ones; the result can be merged again."""
    return sketches.groupBy(*keys).agg(
        F.sum("rows").alias("rows"),
        F.sum("values").alias("values"),
        F.sum("total").alias("total"),
        F.kll_merge_agg_double("quantiles", F.lit(QUANTILE_SIZE)).alias("quantiles"),
        F.theta_union_agg("distinct", F.lit(LOG_DISTINCT_SIZE)).alias("distinct"),
    )


def estimates(merged: DataFrame, quantiles: Mapping[str, float], average: str, distinct: str) -> DataFrame:
    """Keys and rows of each group, its average, its named quantiles, and how many distinct values it has.

    Groups without a value have NULL statistics and the distinct values they do have.
    """
    some = F.col("values") > 0
    found = {
        average: F.when(some, F.col("total") / F.col("values")),
        **{
            name: F.when(some, F.kll_sketch_get_quantile_double("quantiles", F.lit(float(rank))))
            for name, rank in quantiles.items()
        },
        distinct: F.theta_sketch_estimate("distinct"),
    }
    keys = [c for c in merged.columns if c not in SKETCHES]
    return merged.select(*keys, "rows", *[c.alias(name) for name, c in found.items()])
