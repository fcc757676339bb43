import itertools

import pytest
from pyspark.sql import functions as F

from lakestrata.llm import hilbert


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2), (4, 2)])
def test_the_curve_moves_one_step_at_a_time(dims, bits):
    points = {hilbert.curve_index(p, bits): p for p in itertools.product(range(1 << bits), repeat=dims)}
    assert sorted(points) == list(range(1 << bits * dims))
    for n in range(1, len(points)):
        assert sum(abs(a - b) for a, b in zip(points[n - 1], points[n])) == 1


def placed(spark, rows, shards):
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, size long")
    dims = [hilbert.category(F.col("source")), hilbert.category(F.col("lang")), hilbert.magnitude(F.col("size"))]
    return hilbert.assign_shards(df, shards, dims, ["doc_id", "size"])


@pytest.mark.parametrize("n,shards", [(1000, 40), (7, 40), (40, 40), (1, 1)])
def test_counts_differ_by_one_at_most(spark, n, shards):
    # Two thirds of the rows agree in everything but the id; ids repeat and are null.
    rows = [(None if i % 50 == 0 else i // 2, "hot" if i % 3 else f"s{i % 7}", None if i % 11 == 0 else "en", i % 900) for i in range(n)]
    found = placed(spark, rows, shards).collect()
    assert sorted((r["doc_id"] or -1, r["size"]) for r in found) == sorted((r[0] or -1, r[3]) for r in rows)
    slots = {}
    for r in found:
        slots.setdefault(r["shard"], []).append(r["slot"])
    sizes = [len(slots.get(k, [])) for k in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and set(slots) <= set(range(shards))
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_rows_with_equal_metadata_stay_together(spark):
    rows = [(i, f"s{i % 4}", "en", 100) for i in range(400)]
    found = placed(spark, rows, 8).select("source", "shard").distinct().groupBy("source").count().collect()
    assert all(r["count"] <= 3 for r in found)


def test_odd_input(spark):
    assert placed(spark, [], 4).collect() == []
    with pytest.raises(ValueError):
        hilbert.assign_shards(spark.range(3).withColumn("slot", F.lit(1)), 4, [F.lit(0)], ["id"])
    with pytest.raises(ValueError):
        hilbert.assign_shards(spark.range(3), 0, [F.lit(0)], ["id"])
    with pytest.raises(ValueError):
        hilbert.with_curve(spark.range(3), [F.lit(0)] * 5, 4)


def test_shards_written(spark, tmp_path):
    assigned = placed(spark, [(i, f"s{i % 4}", "en", i) for i in range(100)], 4)
    hilbert.write_shards(assigned, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 100 and back.select("shard").distinct().count() == 4
