"""Statistics of daily rows kept as sketches, so that a range of days needs no pass over its rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakestrata import commits
from lakestrata.operators import merge_sketches, sketch_by


def store_daily(
    rows: DataFrame,
    root: str,
    day: str,
    keys: Sequence[str],
    value: str,
    distinct: str,
    days: Collection[dt.date] | None = None,
) -> None:
    """Sketch ``rows`` per day and key, for all days or to replace those of ``days``.

    With ``days``, ``rows`` need only hold these: a day without rows is forgotten, others stay as they are.
    """
    if days is None:
        commits.commit(sketch_by(rows, [day, *keys], value, distinct), root, day)
    else:
        days = sorted(set(days))
        fresh = sketch_by(rows.where(F.col(day).isin(days)), [day, *keys], value, distinct)
        commits.replace_values(fresh, root, day, days)
    commits.release(rows.sparkSession, root)


def merged_range(
    spark: SparkSession, root: str, day: str, keys: Sequence[str], first: dt.date, last: dt.date
) -> DataFrame:
    """Sketches of ``first`` to ``last`` (both included) merged per key; only files that hold these days are read."""
    days = [first + dt.timedelta(days=n) for n in range((last - first).days + 1)]
    return merge_sketches(commits.read_committed(spark, root, None, day, days), keys)
