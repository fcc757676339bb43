"""Sharding along a Hilbert curve over several metadata dimensions, cut into runs of rows.

Rows that agree on most dimensions get close places on the curve, so each shard covers a small
box of the metadata space and file statistics prune on every dimension, not only the first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

BITS = 4  # per dimension
MOST_CELL_BITS = 16  # bounds the table of cells at 65,536 rows
SLICE_BITS = 10  # a hot cell is ranked in 1,024 slices


def category(value: Column, bits: int = BITS) -> Column:
    """A text dimension as one of 2^bits codes; null counts as empty."""
    return F.pmod(F.xxhash64(F.coalesce(value.cast("string"), F.lit(""))), F.lit(1 << bits))


def magnitude(value: Column, bits: int = BITS) -> Column:
    """A size dimension as its binary logarithm; null, negative and small sizes are 0."""
    level = F.floor(F.log2(F.greatest(F.coalesce(value, F.lit(0)), F.lit(1)).cast("double")))
    return F.least(level, F.lit((1 << bits) - 1)).cast("long")


def curve_index(point: Sequence[int], bits: int) -> int:
    """Place of a grid point on the Hilbert curve, by the transposed form of the index."""
    x = list(point)
    n = len(x)
    step = 1 << (bits - 1)
    while step > 1:
        low = step - 1
        for i in range(n):
            if x[i] & step:
                x[0] ^= low
            else:
                swap = (x[0] ^ x[i]) & low
                x[0] ^= swap
                x[i] ^= swap
        step >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = 0
    step = 1 << (bits - 1)
    while step > 1:
        if x[n - 1] & step:
            flip ^= step - 1
        step >>= 1
    index = 0
    for bit in range(bits - 1, -1, -1):
        for value in x:
            index = index << 1 | ((value ^ flip) >> bit & 1)
    return index


def with_curve(df: DataFrame, dimensions: Sequence[Column], bits: int = BITS) -> DataFrame:
    """Add ``_curve``. The grid has at most 2^16 cells, so its table may be broadcast."""
    total = bits * len(dimensions)
    if not dimensions or total > MOST_CELL_BITS:
        raise ValueError(f"{len(dimensions)} dimensions of {bits} bits; at most {MOST_CELL_BITS} bits")
    cells = []
    for cell in range(1 << total):
        point = [cell >> bits * (len(dimensions) - 1 - i) & (1 << bits) - 1 for i in range(len(dimensions))]
        cells.append((cell, curve_index(point, bits)))
    table = df.sparkSession.createDataFrame(cells, "_cell long, _curve long")
    code = F.lit(0).cast("long")
    for dimension in dimensions:
        code = F.shiftleft(code, bits).bitwiseOR(dimension.cast("long"))
    return df.withColumn("_cell", code).join(F.broadcast(table), "_cell").drop("_cell")


def assign_shards(
    df: DataFrame, shards: int, dimensions: Sequence[Column], ties: Sequence[str], bits: int = BITS
) -> DataFrame:
    """All rows of ``df`` with ``shard`` (0 to shards-1) and ``slot`` (gapless from 0 in a shard).

    Rows are ordered by curve index, then by a hash of ``ties``, then by ``ties``; shard counts
    differ by one at most. A place in the order is the rows in earlier slices plus the place in
    the own slice, so no task sees more than a slice of a cell: a group of rows with equal
    metadata is spread over 1,024 slices. Rows equal in all ``ties`` are interchangeable. An
    empty table gives an empty result. Columns named ``shard``, ``slot``, ``_curve``, ``_tie``,
    ``_slice`` or ``_before`` are not allowed in the input.
    """
    clash = {"shard", "slot", "_cell", "_curve", "_tie", "_slice", "_before", "_rows"} & set(df.columns)
    if clash:
        raise ValueError(f"columns in the way: {sorted(clash)}")
    if shards < 1:
        raise ValueError("at least one shard")
    keyed = with_curve(df, dimensions, bits).withColumn("_tie", F.xxhash64(*ties))
    keyed = keyed.withColumn("_slice", F.shiftrightunsigned("_tie", 64 - SLICE_BITS))
    slices = keyed.groupBy("_curve", "_slice").agg(F.count("*").alias("_n"))
    cells = slices.groupBy("_curve").agg(F.sum("_n").alias("_n"))
    # One row per cell, 65,536 at most.
    everything = Window.orderBy("_curve")
    earlier = everything.rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(
        "_curve",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_cells_before"),
        F.sum("_n").over(everything.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_rows"),
    )
    within = Window.partitionBy("_curve").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        slices.withColumn("_slices_before", F.coalesce(F.sum("_n").over(within), F.lit(0)))
        .join(F.broadcast(cells), "_curve")
        .select("_curve", "_slice", (F.col("_cells_before") + F.col("_slices_before")).alias("_before"), "_rows")
    )
    place = F.row_number().over(Window.partitionBy("_curve", "_slice").orderBy("_tie", *ties))
    ranked = keyed.withColumn("_place", place).join(offsets, ["_curve", "_slice"])
    ranked = ranked.withColumn("_rank", F.col("_before") + F.col("_place") - 1)
    shard = F.expr(f"int(_rank * {shards} div _rows)")
    first = F.expr(f"(shard * _rows + {shards - 1}) div {shards}")
    return (
        ranked.withColumn("shard", shard)
        .withColumn("slot", F.col("_rank") - first)
        .select(*df.columns, "shard", "slot")
    )


def write_shards(assigned: DataFrame, path: str) -> None:
    """One folder per shard, rows in curve order inside, so that file statistics prune."""
    assigned.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
