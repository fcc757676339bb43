"""One row per key, the same row on every run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def keep_latest(
    df: DataFrame, keys: Sequence[str], newest: Sequence[str | Column] = ()
) -> DataFrame:
    """The newest row per key: the one with the largest ``newest``, NULL being oldest.

    A column of ``df`` given by name is its own mark and carried once; other marks are expressions.

    Ties are settled by all remaining columns, so the answer does not depend on
    how the input was split. It is one aggregate, a maximum over whole rows:
    every task reduces its rows to one per key before the shuffle, so a key that
    holds a third of the table costs the last stage one row per upstream task.
    """
    named = [c for c in newest if isinstance(c, str) and c not in keys]
    marks = [
        mark if isinstance(mark, str) else mark.alias(f"_newest{n}")
        for n, mark in enumerate(newest)
        if not isinstance(mark, str) or mark in named
    ]
    others = [c for c in df.columns if c not in keys and c not in named]
    if not marks and not others:
        return df.distinct()
    best = df.groupBy(*keys).agg(F.max(F.struct(*marks, *others)).alias("_best"))
    return best.select(*[F.col(c if c in keys else f"_best.{c}") for c in df.columns])


def drop_duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key with no order asked for: any row would do, ours is repeatable."""
    return keep_latest(df, keys)
