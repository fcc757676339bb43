import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakestrata.llm import whitening as wh


def usable(v):
    return v is not None and len(v) > 0 and all(c is not None and math.isfinite(c) for c in v)


def check(spark, rows, most=16, kind="float"):
    """Compares with a plain eigenvalue solver; returns the rows found."""
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").withColumn("x", F.lit(1)).withColumn("n", F.lit("a"))
    found = wh.whiten(df.repartition(4), most).collect()
    xs = {}
    for key, v in rows:
        if usable(v):
            kept = np.float32(v).astype(float) if kind == "float" else np.float64(v)
            xs.setdefault(key, []).append([math.floor(64 * c) + 1_000_000 for c in kept.tolist()])
    fit = sorted({tuple(x) for same in xs.values() for x in same})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    exact = np.array([[n * c - s for c, s in zip(x, sums)] for x in fit], float) / n
    cov = exact.T @ exact / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    count = min(most, int((values > values[0] * len(cov) * np.finfo(float).eps * 4).sum()))
    assert len(found) == count * sum(len(s) for s in xs.values())
    by = {}
    for r in found:
        assert r.n == n and r.identity_error < 1e-9
        assert r.explained == pytest.approx(values[r.component - 1] / np.trace(cov), rel=1e-9)
        by.setdefault((r.vec_id, int(r.deviation)), {}).setdefault(r.component, []).append(r.whitened)
    signs = {}
    for key, same in xs.items():
        for x in same:
            v = np.array([n * c - s for c, s in zip(x, sums)], float) / n
            mine = by[key, sum((n * c - s) ** 2 for c, s in zip(x, sums))]
            for k in range(count):
                want = v @ vectors[:, k] / math.sqrt(values[k])
                got = min(mine[k + 1], key=lambda g: abs(abs(g) - abs(want)))
                assert abs(got) == pytest.approx(abs(want), abs=1e-7)
                if abs(want) > 1e-6:
                    signs.setdefault(k, set()).add(np.sign(got) == np.sign(want))
    assert all(len(s) == 1 for s in signs.values())
    return found


def vectors(count, size, seed=1):
    rng = np.random.default_rng(seed)
    mixed = rng.normal(size=(count, size)) * np.linspace(0.5, 4, size) @ np.linalg.qr(rng.normal(size=(size, size)))[0]
    return [(i, v.tolist()) for i, v in enumerate(mixed)]


@pytest.mark.parametrize("size,kind", [(24, "float"), (7, "double"), (1, "double")])
def test_matches_a_plain_solver(spark, size, kind):
    rows = vectors(300, size)
    check(spark, rows + rows[:40] + [(1000 + i, rows[0][1]) for i in range(50)], kind=kind)


def test_dependent_dimensions_give_fewer_components(spark):
    rows = [(i, [a, 2 * a, -a, b, 5.0]) for i, (a, b) in enumerate(np.random.default_rng(3).integers(-50, 50, (200, 2)).astype(float).tolist())]
    assert {r.component for r in check(spark, rows, kind="double")} == {1, 2}


def test_odd_vectors(spark):
    bad = [(500, None), (501, []), (502, [None, 1.0, 2.0]), (503, [math.nan, 1.0, 2.0]), (504, [1.0, math.inf, 2.0])]
    rows = vectors(50, 3) + [(None, [1.0, 2.0, 3.0]), (7, [0.0, 0.0, 0.0])]
    check(spark, rows + bad, kind="double")
    one = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert wh.whiten(one).collect() == []
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert wh.whiten(empty).collect() == []
    assert wh.whiten(empty).columns == wh.whiten(one).columns


def test_most_frequent_length_is_whitened(spark):
    rows = vectors(30, 4) + [(100 + i, [1.0 * i, 2.0]) for i in range(10)] + [(200, [1e300, 1.0, 2.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert {r.vec_id for r in wh.whiten(df).collect()} == set(range(30))


def test_whole_numbers_beyond_64_bits():
    x = np.array([[1 << 51, 5], [3, 1 << 52]])
    parts = wh.centred(x, 1 << 40, [1 << 80, 7])
    assert [[int(c) for c in row] for row in parts] == [[(1 << 91) - (1 << 80), (5 << 40) - 7], [(3 << 40) - (1 << 80), (1 << 92) - 7]]
    assert wh.deviations(np.array([[1 << 40, 3]]), 1) == [(1 << 80) + 9]


@pytest.mark.parametrize("size", [2, 5, 16, 33])
def test_eigenvalues_keep_their_digits(size):
    rng = np.random.default_rng(size)
    turn = np.linalg.qr(rng.normal(size=(size, size)))[0]
    values = 10.0 ** np.linspace(6, -2, size)
    components, found = wh.eigen_of_scatter((turn * values) @ turn.T, size)
    assert found == pytest.approx(values, rel=1e-6)
    assert np.abs(components.T @ components - np.eye(size)).max() < 1e-9


def test_blocks_are_added_in_two_steps(spark, monkeypatch):
    monkeypatch.setattr(wh, "BLOCK_VALUES", 10)
    monkeypatch.setattr(wh, "FIRST_SUMS", 2)
    check(spark, vectors(200, 6), kind="double")
