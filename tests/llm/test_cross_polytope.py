import numpy as np
import pytest
from pyspark.sql import functions as F

from lakestrata.llm import cross_polytope as cp


def brute_force(rows):
    ids = [r[0] for r in rows]
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    unit = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if good else None for (_, v), good in zip(rows, ok)]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if ok[i] and ok[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.9:
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    smallest = {}
    for i, key in enumerate(ids):
        smallest[find(i)] = min(key, smallest.get(find(i), key))
    return sorted((k, n, smallest[find(i)], smallest[find(i)] == k) for i, (k, n) in enumerate(zip(ids, links)))


def found(spark, rows, kind="float"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int" if len(rows[0]) == 3 else f"vec_id long, embedding array<{kind}>")
    return sorted(map(tuple, cp.near_vectors(df.repartition(3)).collect()))


@pytest.mark.parametrize("kind,block", [("float", 1024), ("double", 16)])
def test_clusters_match_brute_force(spark, monkeypatch, kind, block):
    monkeypatch.setattr(cp, "BLOCK", block)
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 24))
    rows = []
    for n in range(400):
        # Noise that leaves no cosine within 0.01 of the threshold to chance of the hash.
        noise = rng.normal(size=24) * rng.choice([0.02, 0.05, 1.0])
        rows.append((int(n * 7 % 400), (base[n % 40] + noise).astype(np.float32).tolist()))
    rows += [(1000 + n, rows[0][1]) for n in range(100)] + [(2000, (np.array(rows[0][1]) * 3).tolist())]
    assert found(spark, rows, kind) == brute_force(rows)


@pytest.mark.parametrize("size,pairs,least", [(64, 3000, 0.99), (384, 1000, 0.95), (768, 600, 0.94), (1024, 500, 0.93), (2048, 300, 0.92), (4096, 200, 0.9)])
def test_recall_at_the_threshold(size, pairs, least):
    rng = np.random.default_rng(5)
    a = rng.normal(size=(pairs, size))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.normal(size=(pairs, size))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = 0.9 * a + np.sqrt(1 - 0.81) * b / np.linalg.norm(b, axis=1, keepdims=True)
    x, y = cp.codes(a), cp.codes(b)
    assert (x[:, :, :, None] == y[:, :, None, :]).any(axis=(1, 2, 3)).mean() >= least


@pytest.mark.parametrize("size", [2048, 4096, 5000])
def test_long_vectors(spark, size):
    rng = np.random.default_rng(size)
    base = rng.normal(size=(3, size))
    rows = [(n, (base[n % 3] + rng.normal(size=size) * 0.05).tolist()) for n in range(12)]
    assert found(spark, rows) == brute_force(rows)


@pytest.mark.parametrize("small,batch", [(1, 10_000), (4, 7), (48, 1)])
def test_buckets_of_any_size_over_batches(spark, monkeypatch, small, batch):
    monkeypatch.setattr(cp, "SMALL", small)
    monkeypatch.setattr(cp, "BLOCK", 20)
    monkeypatch.setattr(cp, "CHUNK", 64)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        rng = np.random.default_rng(9)
        base = rng.normal(size=(5, 16))
        rows = [(n, (base[n * n % 5] + rng.normal(size=16) * 0.04).tolist()) for n in range(120)]
        rows += [(200 + n, [1.0, float(n % 2)]) for n in range(6)]
        assert found(spark, rows) == brute_force(rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_odd_vectors(spark):
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]),
        (7, [1.0, 0.0]), (8, [1e-30, 0.0]), (9, [1e30, 0.0]), (10, [1.0, 0.0, 0.0]), (11, [5.0]), (12, [2.0]), (13, [-2.0]),
    ]
    assert found(spark, rows, "double") == brute_force(rows)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert cp.near_vectors(empty).collect() == []


def test_vector_without_id_links_with_nothing(spark):
    df = spark.createDataFrame([(None, [1.0]), (1, [1.0]), (1, [1.0])], "vec_id long, embedding array<double>")
    rows = sorted(map(tuple, cp.near_vectors(df).collect()), key=str)
    assert rows == [(1, 1, 1, True), (1, 1, 1, True), (None, 0, None, True)]


def test_extra_columns(spark):
    df = spark.createDataFrame([(1, [1.0, 0.1], 9)], "vec_id long, embedding array<double>, k1 int").withColumn("rep", F.lit(1))
    assert [tuple(r) for r in cp.near_vectors(df).collect()] == [(1, 0, 1, True)]


@pytest.mark.parametrize("small,chunk", [(48, 1 << 21), (3, 8), (0, 64)])
def test_pairs_of_groups_of_any_size(monkeypatch, small, chunk):
    monkeypatch.setattr(cp, "SMALL", small)
    monkeypatch.setattr(cp, "CHUNK", chunk)
    rng = np.random.default_rng(1)
    sizes = np.array([1, 5, 2, 60, 1, 9])
    starts = np.cumsum(sizes) - sizes
    unit = rng.normal(size=(sizes.sum(), 4))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    across, block = np.array([False, True, False, True, False, False]), rng.integers(0, 2, sizes.sum())
    one, two = cp._near_pairs(unit, starts, across, block, 0.6)
    wanted = {
        (i, j)
        for g, (s, n) in enumerate(zip(starts, sizes)) for i in range(s, s + n) for j in range(i + 1, s + n)
        if unit[i] @ unit[j] >= 0.6 and not (across[g] and block[i] == block[j])
    }
    assert len(one) == len(wanted) and set(zip(one.tolist(), two.tolist())) == wanted
    reached = cp._least_reachable(one, two, np.arange(len(unit))[::-1])
    for i, j in wanted:
        assert reached[i] == reached[j]
