"""Near-duplicate vectors by cross-polytope hashing after fast Hadamard rotations.

A rotation is three rounds of random signs and a Hadamard transform; the hash is the signed axis
nearest to the rotated vector. A bucket is three hashes; each vector enters its best buckets of a table
(multiprobe, by how little is lost when second-best axes are taken). Pairs of a bucket are
verified by cosine in double precision, and each is counted in its first common bucket only, so neither
links nor candidates are written out as pairs. A worker takes buckets as they come in a sorted partition,
many small ones at once.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakestrata.layout import materialize
from lakestrata.llm.components import components

COSINE = 0.9
TABLES = 10
HASHES = 3  # per bucket
PROBES = 4  # buckets per table and vector, and more for long ones
MORE_PROBES = {512: 6, 1024: 8, 2048: 12, 4096: 17}  # from this many axes on
NEAR_AXES = 3  # axes per hash that probes may take
BLOCK = 1024  # a larger bucket is compared block by block
SMALL = 48  # members of a bucket whose pairs are compared together with those of others
CHUNK = 1 << 21  # components compared at once


def hadamard(x: np.ndarray) -> np.ndarray:
    """Normalised transform of the rows; their length is a power of two."""
    n, size = x.shape
    half = 1
    while half < size:
        x = x.reshape(n, -1, 2, half)
        x = np.concatenate([x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]], axis=2).reshape(n, size)
        half *= 2
    return x / np.sqrt(size)


def probes_of(size: int) -> int:
    """Probes for vectors of ``size`` axes: signs and axes are more, so near vectors share fewer of them."""
    return max([PROBES, *(probes for least, probes in MORE_PROBES.items() if size >= least)])


def codes(unit: np.ndarray, tables: int = TABLES, probes: int | None = None) -> np.ndarray:
    """Bucket codes (vectors x tables x probes) of unit vectors."""
    n, dim = unit.shape
    size = 1 << max(1, (dim - 1).bit_length())
    padded = np.zeros((n, size))
    padded[:, :dim] = unit
    near = min(NEAR_AXES, size)
    picks = sorted((p for p in itertools.product(range(near), repeat=HASHES) if sum(p) < NEAR_AXES + 1), key=lambda p: (sum(p), p))
    probes = min(probes or probes_of(size), len(picks))
    out = np.empty((n, tables, probes), np.int64)
    for table in range(tables):
        rng = np.random.default_rng([table, size])
        code = np.zeros((n, len(picks)), np.int64)
        lost = np.zeros((n, len(picks)))
        for which in range(HASHES):
            y = padded
            for _ in range(3):
                y = hadamard(y * rng.choice([-1.0, 1.0], size))
            axes = np.argsort(-np.abs(y), axis=1, kind="stable")[:, :near]
            value = np.take_along_axis(y, axes, 1)
            place = [p[which] for p in picks]
            code = code * (2 * size) + (2 * axes + (value < 0))[:, place]
            lost += ((np.abs(value[:, :1]) - np.abs(value)) ** 2)[:, place]
        best = np.argsort(lost, axis=1, kind="stable")[:, :probes]
        out[:, table] = np.take_along_axis(code, best, 1)
    return out


def _unit(raw: list[bytes], dtype: str) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), dtype).reshape(len(raw), -1).astype(float)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares of tiny or huge components would not fit
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def valid_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, vector, k1, k2) of vectors that can link: with an id, components, all finite, not all zero."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    rows = embeddings.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(~bad & some)
    return rows.select(
        "vec_id", F.col("embedding").alias("vector"), F.xxhash64("embedding").alias("k1"), F.xxhash64(F.lit(7), "embedding").alias("k2")
    )


def hashed(distinct: DataFrame) -> DataFrame:
    """Adds raw components, their number, and the codes of each table to distinct vectors."""
    single = "float" in distinct.schema["vector"].dataType.simpleString()
    dtype, kind = ("<f4", pa.float32()) if single else ("<f8", pa.float64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("vector").value_lengths().to_numpy()
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                for at in range(0, part.num_rows, rows := max(16, CHUNK // int(size))):
                    yield _coded(part.slice(at, rows), int(size), dtype, kind)

    schema = "k1 long, k2 long, rep long, copies long, size int, raw binary, codes array<long>"
    return materialize(distinct.mapInArrow(run, schema), "hashed-vectors")


def _coded(part: pa.RecordBatch, size: int, dtype: str, kind: pa.DataType) -> pa.RecordBatch:
    values = part.column("vector").flatten().cast(kind).to_numpy().astype(dtype)
    raw = [v.tobytes() for v in values.reshape(-1, size)]
    code = codes(_unit(raw, dtype))
    ends = np.arange(len(code) + 1, dtype=np.int32) * (code.shape[1] * code.shape[2])
    return pa.RecordBatch.from_pydict({
        "k1": part.column("k1"), "k2": part.column("k2"), "rep": part.column("rep"), "copies": part.column("copies"),
        "size": pa.array(np.full(len(code), size, np.int32)),
        "raw": pa.array(raw, pa.binary()),
        "codes": pa.ListArray.from_arrays(ends, pa.array(code.ravel())),
    })


def _near_pairs(unit: np.ndarray, starts: np.ndarray, across: np.ndarray, block: np.ndarray, cosine: float):
    """(one, two): places of vectors of one group with a cosine of at least ``cosine``.

    A group begins at each of ``starts``; where ``across``, only pairs of different blocks count.
    """
    ends = np.append(starts[1:], len(unit))
    sizes = ends - starts
    end, whole = np.repeat(ends, sizes), ~np.repeat(across, sizes)
    one, two = [], []
    small = np.repeat(sizes <= SMALL, sizes)
    here = np.flatnonzero(small)
    for step in range(1, int(sizes[sizes <= SMALL].max(initial=0))):
        here = here[here + step < end[here]]
        x = here[whole[here] | (block[here] != block[here + step])]
        for at in range(0, len(x), rows := max(64, CHUNK // unit.shape[1])):
            i = x[at : at + rows]
            near = np.einsum("ij,ij->i", unit[i], unit[i + step]) >= cosine
            one.append(i[near])
            two.append(i[near] + step)
    for group in np.flatnonzero(sizes > SMALL):
        own = slice(starts[group], ends[group])
        near = np.triu(unit[own] @ unit[own].T >= cosine, 1)
        if across[group]:
            near &= block[own][:, None] != block[own][None, :]
        i, j = np.nonzero(near)
        one.append(i + starts[group])
        two.append(j + starts[group])
    return (np.concatenate([np.empty(0, np.int64), *x]) for x in (one, two))


def _first_common(a: np.ndarray, b: np.ndarray, table: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Whether (table, code) of each pair is the first bucket that the rows of ``a`` and ``b`` (pairs x tables x probes) share.

    Close vectors mostly share a bucket of the first table, so few pairs are left for later ones.
    """
    left = np.arange(len(a))
    first = np.zeros(len(a), bool)
    for t in range(a.shape[1]):
        x, y = a[left, t], b[left, t]
        common = x[:, :, None] == y[:, None, :]
        last = table[left] == t
        common &= ~last[:, None, None] | (x < code[left, None])[:, :, None]
        none = ~common.any(axis=(1, 2))
        first[left[none & last]] = True
        left = left[none & ~last]
        if not len(left):
            break
    return first


def _least_reachable(one: np.ndarray, two: np.ndarray, rep: np.ndarray) -> np.ndarray:
    """Smallest ``rep`` that each place reaches by the pairs."""
    order = np.argsort(rep, kind="stable")
    rank = np.empty(len(rep), np.int64)
    rank[order] = np.arange(len(rep))
    x, y = rank[one], rank[two]
    label = np.arange(len(rep))
    while True:
        least = label.copy()
        np.minimum.at(least, x, label[y])
        np.minimum.at(least, y, label[x])
        least = least[least]
        if (least == label).all():
            return rep[order][label[rank]]
        label = least


GROUP = ["size", "table", "code", "low", "high"]


def _groups_linked(rows: pa.Table, dtype: str, cosine: float) -> pa.RecordBatch:
    """Links of whole groups of vectors of one size, which lie one after another."""
    code, low, high, table, rep, copies, block = (
        rows[c].to_numpy() for c in ("code", "low", "high", "table", "rep", "copies", "block")
    )
    changes = np.zeros(len(code), bool)
    changes[0] = True
    for column in (table, code, low, high):
        changes[1:] |= column[1:] != column[:-1]
    starts = np.flatnonzero(changes)
    unit = _unit(rows["raw"].to_pylist(), dtype)
    one, two = _near_pairs(unit, starts, low[starts] != high[starts], block, cosine)
    every = rows["codes"].combine_chunks().flatten().to_numpy().reshape(len(unit), TABLES, -1)
    links = np.zeros(len(unit), np.int64)
    for at in range(0, len(one), 50_000):
        x, y = one[at : at + 50_000], two[at : at + 50_000]
        first = _first_common(every[x], every[y], table[x], code[x])
        np.add.at(links, x[first], copies[y[first]])
        np.add.at(links, y[first], copies[x[first]])
    hook = _least_reachable(one, two, rep)
    keep = pa.array((links > 0) | (hook != rep))
    out = pa.table({
        "k1": rows["k1"], "k2": rows["k2"], "rep": rows["rep"], "n_links": pa.array(links), "hook": pa.array(hook),
    }).filter(keep)
    return pa.RecordBatch.from_pydict({c: out[c].combine_chunks() for c in out.column_names})


def bucket_links(members: DataFrame, dtype: str, cosine: float = COSINE) -> DataFrame:
    """(k1, k2, rep, n_links, hook) per member and block pair of a bucket with a link in it."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [batch.column(c) for c in GROUP]
            ends = np.zeros(batch.num_rows, bool)
            for key in keys:
                values = key.to_numpy()
                ends[1:] |= values[1:] != values[:-1]
            begin = tuple(key[0].as_py() for key in keys)
            # Where the group that goes on into the next batch begins.
            cut = int(np.flatnonzero(ends)[-1]) if ends.any() else (0 if begin != last else -1)
            if cut >= 0:
                yield from whole([*held, batch.slice(0, cut)])
                held = []
            held.append(batch.slice(max(cut, 0)))
            last = tuple(key[-1].as_py() for key in keys)
        yield from whole(held)

    def whole(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not sum(p.num_rows for p in parts):
            return
        rows = pa.Table.from_batches(parts).combine_chunks()
        sizes = rows["size"].to_numpy()
        edges = np.concatenate(([0], np.flatnonzero(sizes[1:] != sizes[:-1]) + 1, [len(sizes)]))
        for low, high in zip(edges[:-1], edges[1:]):
            yield _groups_linked(rows.slice(low, high - low).combine_chunks(), dtype, cosine)

    dealt = members.repartition(*GROUP).sortWithinPartitions(*GROUP)
    return dealt.mapInArrow(scan, "k1 long, k2 long, rep long, n_links long, hook long")


def near_vectors(embeddings: DataFrame, cosine: float = COSINE) -> DataFrame:
    """Per row of ``embeddings``: vec_id, n_links, component_id, kept (it is its component's first).

    Equal vectors are compared once and counted as often as they occur. A vector that is null, empty or zero,
    or holds a null or a non-finite component, and one without vec_id, links with nothing and
    is a component of its own. Rows of one vec_id are one node of the components. Vectors
    of different length do not link. An empty table gives an empty result.
    """
    vectors = valid_vectors(embeddings)
    distinct = vectors.groupBy("k1", "k2").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.any_value("vector").alias("vector")
    )
    table = hashed(distinct)
    probes = (F.size("codes") / TABLES).cast("int")
    placed = table.select("k1", "k2", "size", probes.alias("probes"), F.posexplode("codes").alias("at", "code"))
    bucket = ["size", "table", "code"]
    placed = placed.select("k1", "k2", "size", F.floor(F.col("at") / F.col("probes")).cast("int").alias("table"), "code")
    full = placed.groupBy(*bucket).agg(F.count("*").alias("n")).where("n > 1")
    placed = placed.join(full, bucket)
    blocks = F.ceil(F.col("n") / BLOCK)
    placed = placed.withColumn("block", F.pmod(F.xxhash64("k1"), blocks))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    placed = placed.select(
        "k1", "k2", *bucket, "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    )
    members = placed.join(table.select("k1", "k2", "rep", "copies", "raw", "codes"), ["k1", "k2"])
    single = "float" in embeddings.schema["embedding"].dataType.simpleString()
    found = materialize(bucket_links(members, "<f4" if single else "<f8", cosine), "vector-links")
    sums = found.groupBy("k1", "k2").agg(F.sum("n_links").alias("others"))
    nodes = components(found.select("rep", "hook"), "rep", "hook")
    whole = table.select("k1", "k2", "rep", "copies").join(sums, ["k1", "k2"], "left")
    whole = whole.join(nodes, whole["rep"] == nodes["node"], "left").select(
        "k1", "k2", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("first")
    )
    rest = embeddings.select("vec_id", F.xxhash64("embedding").alias("k1"), F.xxhash64(F.lit(7), "embedding").alias("k2"))
    joined = rest.join(whole, ["k1", "k2"], "left")
    known = F.col("vec_id").isNotNull() & F.col("first").isNotNull()
    component = F.when(known, F.col("first")).otherwise(F.col("vec_id")).cast("long")
    return joined.select(
        "vec_id", F.when(known, F.col("n_links")).otherwise(F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
