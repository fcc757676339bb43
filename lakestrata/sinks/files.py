"""File writers. Counts of what was written come from the write's own pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F


def observed(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """``df`` plus an Observation filled by the next action on it; rows by default."""
    counter = Observation(name)
    chosen = metrics or {"rows": F.count(F.lit(1))}
    return df.observe(counter, *[m.alias(n) for n, m in chosen.items()]), counter


def write_parquet(df: DataFrame, path: str) -> None:
    """Replace the directory with the rows of ``df``. ``path`` must not feed ``df``."""
    df.write.mode("overwrite").parquet(path)


# Up to this size one task may write a value alone, however much of the data it holds.
SMALL_BYTES = 1 << 30


def estimated_bytes(df: DataFrame) -> int:
    """What the optimiser expects ``df`` to hold, from the sizes of the files it reads."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def clustered(df: DataFrame, column: str) -> DataFrame:
    """Rows of a value of ``column`` brought together, for a write whose cost is its many values.

    Large data is rebalanced: AQE merges small values and cuts a value that holds much of the data into
    pieces of the advisory size, so no task has to take a hot day alone. It would merge small
    data into one task, which then opens a file per value one after another; such
    data is dealt out to all cores instead.
    """
    if estimated_bytes(df) > SMALL_BYTES:
        return df.hint("rebalance", F.col(column))
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, column)


def write_partitioned(
    df: DataFrame, path: str, column: str, *, replay: bool = False, as_is: bool = False
) -> None:
    """Write one folder per value of ``column``.

    Rows are first :func:`clustered` by it, so a day has few files however the input lay. ``as_is`` says that
    they lie so already: every task then writes the days it reads, without a shuffle.

    ``replay`` replaces only the days present in ``df``; otherwise everything.
    """
    (
        (df if as_is else clustered(df, column))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if replay else "static")
        .partitionBy(column)
        .parquet(path)
    )


def write_csv(df: DataFrame, path: str) -> None:
    """Replace the directory with CSV parts, each with a header row."""
    df.write.mode("overwrite").csv(path, header=True)
