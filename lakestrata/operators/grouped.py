"""Grouped statistics and top-k. All aggregate on the map side before shuffling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def average_by(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(value).alias(name))


def median_by(
    df: DataFrame, keys: Sequence[str], value: str, name: str, accuracy: int = 10_000
) -> DataFrame:
    """Lower median from mergeable summaries of bounded size.

    Exact while a group has fewer than ``accuracy / 2`` rows; beyond that the
    rank is off by at most one part in ``accuracy``.
    """
    return df.groupBy(*keys).agg(F.percentile_approx(value, 0.5, accuracy).alias(name))


def distinct_count_by(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Exact distinct count; de-duplicated by (keys, value) first, so hot keys spread."""
    return df.groupBy(*keys).agg(F.count_distinct(F.col(value)).alias(name))


def sum_by(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(value).alias(name))


def count_by(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Non-NULL values per group; a NULL key is a group of its own."""
    return df.groupBy(*keys).agg(F.count(value).alias(name))


def rows_by(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def top_k(df: DataFrame, score: str, k: int = 1, ties: Sequence[str | Column] = ()) -> DataFrame:
    """The ``k`` rows with the highest score; ``ties`` makes the choice repeatable.

    Each task keeps k rows, so nothing is sorted as a whole.
    """
    return df.orderBy(F.col(score).desc(), *ties).limit(k)
