"""Whitening of embeddings by a pivoted Cholesky factor and one-sided Jacobi rotations.

Vectors are taken as integers. Sums and the centred scatter matrix of the distinct ones are added up
task by task, so the driver sees one matrix whatever the number of vectors. A Cholesky factorisation
with diagonal pivots gives a triangular factor of the scatter; its columns are rotated pairwise until
they are orthogonal. Then their squared lengths are the eigenvalues of the scatter, and the
columns at length one its eigenvectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from lakestrata.layout import materialize

SCALE = 64
SHIFT = 1_000_000
# Larger entries have no exact place among doubles once scaled, and count as non-finite.
LARGEST = float(1 << 46)
COMPONENTS = 16
MOST_DIMENSIONS = 4096  # the scatter matrix on the driver is their square
SWEEPS = 60
BLOCK_VALUES = 1 << 16  # of the scatter matrix in one row of a shuffle
FIRST_SUMS = 64  # tasks that add up each block before the last one does


def shifted(embeddings: DataFrame) -> DataFrame:
    """(vec_id, x): x = floor(64 c) + 1000000 of every usable vector; see :func:`whiten` for the others."""
    at_fault = F.exists("embedding", lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) >= LARGEST))
    usable = embeddings.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0)).where(~at_fault)
    entry = lambda c: F.floor(c.cast("double") * SCALE).cast("long") + SHIFT
    return usable.select("vec_id", F.transform("embedding", entry).alias("x"))


def _matrix(batch: pa.RecordBatch, size: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(-1, size)


def sums_of(fit: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and exact sums of each dimension, all of one length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)
                # A sum of a batch may pass 63 bits only with entries near the largest.
                low, high = (x & 0xFFFF).sum(axis=0), (x >> 16).sum(axis=0)
                yield pa.RecordBatch.from_pydict({
                    "i": pa.array(np.arange(x.shape[1])), "low": pa.array(low), "high": pa.array(high), "n": pa.array(np.full(x.shape[1], len(x))),
                })

    found = fit.mapInArrow(run, "i long, low long, high long, n long")
    whole = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    rows = found.groupBy("i").agg(whole("low").alias("low"), whole("high").alias("high"), F.sum("n").alias("n")).collect()
    rows.sort(key=lambda r: r["i"])
    return rows[0]["n"], [int(r["low"]) + (int(r["high"]) << 16) for r in rows]


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S in whole numbers: 64 bits where they fit, Python's own where not."""
    most = max(1, int(np.abs(x).max(initial=0)), *(abs(s) // n + 1 for s in sums))
    if 2 * n * most < 1 << 62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def deviations(parts: np.ndarray, n: int) -> list[int]:
    """Exact sum of squares of each row."""
    most = int(np.abs(parts).max(initial=0))
    if parts.dtype == object or most * most * parts.shape[1] >= 1 << 62:
        parts = parts.astype(object)
    return [int(v) for v in (parts * parts).sum(axis=1)]


def _add_blocks(parts: DataFrame, by: list[str]) -> DataFrame:
    """Adds up rows (block, salt, values) of equal ``by``, one row of each in memory at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}
        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in by))
            for key, raw in zip(keys, batch.column("values")):
                values = np.frombuffer(raw.as_buffer(), "<f8")
                if key in held:
                    held[key] += values
                else:
                    held[key] = values.copy()
        if held:
            keys = dict(zip(by, zip(*held)))
            yield pa.RecordBatch.from_pydict({
                "block": pa.array(keys["block"], pa.int64()),
                "salt": pa.array(keys.get("salt", [0] * len(held)), pa.int64()),
                "values": pa.array([v.tobytes() for v in held.values()], pa.binary()),
            })

    return parts.repartition(*by).mapInArrow(run, "block long, salt long, values binary")


def scatter_of(fit: DataFrame, n: int, sums: list[int], onto: np.ndarray | None = None) -> np.ndarray:
    """Sum of v v' over all vectors x, v = x - S / n, or its projection on the columns of ``onto``.

    Every task sums its own vectors. Blocks of its rows are added up in two steps, so no task
    takes one block of every other task.
    """
    size = len(sums)
    width = size if onto is None else onto.shape[1]
    rows = max(1, BLOCK_VALUES // width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                v = (centred(_matrix(batch, size), n, sums) / n).astype(float)
                v = v if onto is None else v @ onto
                total = v.T @ v if total is None else total + v.T @ v
        if total is not None:
            starts = range(0, width, rows)
            salt = TaskContext.get().partitionId() % FIRST_SUMS
            yield pa.RecordBatch.from_pydict({
                "block": pa.array([s // rows for s in starts], pa.int64()),
                "salt": pa.array([salt] * len(starts), pa.int64()),
                "values": pa.array([total[s : s + rows].tobytes() for s in starts], pa.binary()),
            })

    parts = fit.mapInArrow(run, "block long, salt long, values binary")
    found = _add_blocks(_add_blocks(parts, ["block", "salt"]), ["block"]).select("block", "values").collect()
    return np.concatenate([np.frombuffer(r["values"], "<f8").reshape(-1, width) for r in sorted(found, key=lambda r: r["block"])])


def pivoted_cholesky(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pivots, lower) with matrix[pivots][:, pivots] = lower lower'; as many columns as its rank.

    The largest remaining diagonal comes next; what is left at rounding level is zero.
    """
    rest = matrix.copy()
    size = len(rest)
    pivots = np.arange(size)
    lower = np.zeros((size, size))
    least = np.abs(np.diag(matrix)).max(initial=0) * size * np.finfo(float).eps
    for k in range(size):
        best = k + int(np.argmax(np.diag(rest)[k:]))
        if rest[best, best] <= least:
            return pivots, lower[:, :k]
        if best != k:
            swap, back = [k, best], [best, k]
            rest[swap] = rest[back]
            rest[:, swap] = rest[:, back]
            lower[swap] = lower[back]
            pivots[swap] = pivots[back]
        lower[k, k] = np.sqrt(rest[k, k])
        lower[k + 1 :, k] = rest[k + 1 :, k] / lower[k, k]
        rest[k + 1 :, k + 1 :] -= np.outer(lower[k + 1 :, k], lower[k + 1 :, k])
    return pivots, lower


def orthogonal_columns(factor: np.ndarray) -> np.ndarray:
    """The columns after Jacobi rotations that make each pair orthogonal, to rounding.

    A sweep meets every pair once, in rounds of pairs without a common column.
    """
    columns = factor.T.copy()
    count = len(columns)
    seats = np.arange(count + count % 2)
    for _ in range(SWEEPS if count > 1 else 0):
        worst = 0.0
        for _ in range(len(seats) - 1):
            one, two = seats[: len(seats) // 2], seats[len(seats) // 2 :][::-1]
            # With an odd count the last seat is empty.
            real = (one < count) & (two < count)
            p, q = one[real], two[real]
            a, b = columns[p], columns[q]
            aa, bb, ab = (a * a).sum(axis=1), (b * b).sum(axis=1), (a * b).sum(axis=1)
            angle = np.abs(ab) / np.sqrt(aa * bb)
            worst = max(worst, angle.max(initial=0))
            turn = angle > np.finfo(float).eps
            with np.errstate(divide="ignore", over="ignore", invalid="ignore"):
                zeta = (bb - aa) / (2 * ab)
                t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta))
            t = np.where(turn, t, 0.0)[:, None]
            c = 1 / np.sqrt(1 + t * t)
            columns[p], columns[q] = c * (a - t * b), c * (t * a + b)
            seats = np.concatenate((seats[:1], seats[-1:], seats[1:-1]))
        if worst <= np.sqrt(factor.shape[0]) * np.finfo(float).eps:
            break
    return columns.T


@dataclass
class Whitening:
    """What a fit learned. ``components`` are unit columns, by falling eigenvalue of the covariance."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float


def eigen_of_scatter(scatter: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(unit components as columns, eigenvalues), falling, of those above rounding level."""
    pivots, lower = pivoted_cholesky(scatter)
    turned = orthogonal_columns(lower)
    values = (turned * turned).sum(axis=0)
    order = np.argsort(-values, kind="stable")[:most]
    components = np.empty((len(scatter), len(order)))
    components[pivots] = turned[:, order] / np.sqrt(values[order])
    return components, values[order]


def fit_whitening(fit: DataFrame, most: int = COMPONENTS) -> Whitening | None:
    """Learns from (x) with vectors of one length, each taken once as it stands there; None without rows."""
    if fit.isEmpty():
        return None
    n, sums = sums_of(fit)
    scatter = scatter_of(fit, n, sums)
    components, values = eigen_of_scatter(scatter, most)
    values = values / n
    error = 0.0
    if len(values):
        covariance = scatter_of(fit, n, sums, components / np.sqrt(values)) / n
        error = float(np.abs(covariance - np.eye(len(values))).max())
    return Whitening(n, sums, components, values, float(np.trace(scatter)) / n, error)


def apply_whitening(rows: DataFrame, model: Whitening) -> DataFrame:
    """(vec_id, deviation decimal, whitened array<double>) of every row of (vec_id, x)."""
    size, n, sums = len(model.sums), model.n, model.sums
    onto = model.components / np.sqrt(model.eigenvalues)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                parts = centred(_matrix(batch, size), n, sums)
                white = (parts / n).astype(float) @ onto
                yield pa.RecordBatch.from_pydict({
                    "vec_id": batch.column("vec_id"),
                    "deviation": pa.array([str(d) for d in deviations(parts, n)]),
                    "whitened": pa.ListArray.from_arrays(
                        pa.array(np.arange(len(white) + 1, dtype=np.int32) * onto.shape[1]), pa.array(white.ravel())
                    ),
                })

    schema = f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, deviation string, whitened array<double>"
    found = rows.mapInArrow(run, schema)
    return found.withColumn("deviation", F.col("deviation").cast("decimal(38,0)"))


def whiten(embeddings: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation decimal, whitened, explained, identity_error) per row and component.

    ``embeddings`` is (vec_id, embedding); other columns have no say. A vector that is null, empty or
    holds a null or non-finite entry is left out, and so is one with an entry of 2^46 or more. Equal vectors are learned
    from once, but every row has its own result, also one without vec_id. Only vectors of the most frequent length (the
    longer of equals) are whitened; that length is at most ``MOST_DIMENSIONS``. Directions without variance
    are no components, so a table of equal vectors, like an empty one, gives an empty result. Equal eigenvalues have
    any orthogonal components of their space, the same for all rows.
    """
    rows = shifted(embeddings)
    lengths = rows.groupBy(F.size("x").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("size"))
    common = lengths.first()
    schema = "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    nothing = rows.select("vec_id", F.from_json(F.lit("{}"), schema).alias("r")).where("false").select("vec_id", "r.*")
    if common is None:
        return nothing
    if common["size"] > MOST_DIMENSIONS:
        raise ValueError(f"vectors of more than {MOST_DIMENSIONS} entries")
    rows = rows.where(F.size("x") == common["size"])
    model = fit_whitening(materialize(rows.select("x").distinct(), "whitening-fit"), most)
    if not len(model.eigenvalues):
        return nothing
    explained = F.array(*(F.lit(float(e)) for e in model.eigenvalues / model.trace))
    found = apply_whitening(rows, model)
    return found.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(explained, F.col("at") + 1).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
