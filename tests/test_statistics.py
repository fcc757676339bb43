import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakestrata import commits
from lakestrata import operators as op
from lakestrata.operators import sketches
from lakestrata.plans import statistics

SCHEMA = "day DATE, k STRING, v DOUBLE, id LONG"
DAY = dt.date(2024, 1, 1)


def day(n):
    return DAY + dt.timedelta(days=n)


def found(df):
    out = op.estimates(df, {"low": 0.1, "median": 0.5}, "average", "ids")
    return sorted((tuple(r) for r in out.collect()), key=repr)


def test_small_groups_are_exact_however_they_are_merged(spark):
    data = [(day(n % 7), "ab"[n % 2], float(n * 37 % 101) if n % 5 else None, n % 13) for n in range(400)]
    data += [(day(1), "none", None, 1), (day(2), None, 2.0, None)]
    df = spark.createDataFrame(data, SCHEMA)
    daily = op.sketch_by(df, ["day", "k"], "v", "id")
    once, weekly = op.merge_sketches(daily, ["k"]), op.merge_sketches(op.merge_sketches(daily, ["day", "k"]), ["k"])
    wanted = []
    for key in ("a", "b", "none", None):
        rows = [r for r in data if r[1] == key]
        values = sorted(r[2] for r in rows if r[2] is not None)
        at = lambda q: values[max(0, -(-len(values) * q // 100) - 1)] if values else None  # noqa: B023, E731
        average = pytest.approx(sum(values) / len(values)) if values else None
        wanted.append((key, len(rows), average, at(10), at(50), len({r[3] for r in rows if r[3] is not None})))
    for merged in (once, weekly):
        assert [tuple(r) for r in found(merged)] == sorted(wanted, key=lambda w: repr(w[:1]))
    assert found(op.merge_sketches(daily.where("false"), ["k"])) == []


def test_error_stays_in_its_bounds(spark):
    df = spark.range(300_000, numPartitions=6).select(
        F.date_add(F.lit(DAY), (F.col("id") % 30).cast("int")).alias("day"),
        F.lit("a").alias("k"),
        F.pmod(F.xxhash64("id"), F.lit(1_000_003)).cast("double").alias("v"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(50_000)).alias("id"),
    )
    merged = op.merge_sketches(op.sketch_by(df, ["day", "k"], "v", "id"), ["k"])
    low, median, ids = found(merged)[0][3:]
    for value, rank in ((low, 0.1), (median, 0.5)):
        assert abs(df.where(F.col("v") <= value).count() / 300_000 - rank) <= 3 * sketches.RANK_ERROR
    exact = df.select("id").distinct().count()
    assert abs(ids / exact - 1) <= 4 / sketches.DISTINCT_SIZE**0.5


def test_days_are_replaced_and_a_range_reads_only_its_files(spark, tmp_path):
    root = str(tmp_path / "daily")
    data = [(day(n), k, float(n + j), j) for n in range(60) for k in "ab" for j in range(3)]
    # Files, so that their size is known.
    spark.createDataFrame(data, SCHEMA).write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    statistics.store_daily(df, root, "day", ["k"], "v", "id")
    late = [(day(4), "a", 1000.0, 77)]
    statistics.store_daily(spark.createDataFrame(late, SCHEMA), root, "day", ["k"], "v", "id", days=[day(4), day(5)])
    kept = [r for r in data if r[0] not in (day(4), day(5))] + late
    for first, last in ((0, 59), (4, 4), (3, 6), (5, 5), (70, 80)):
        wanted = op.sketch_by(spark.createDataFrame(kept, SCHEMA).where(F.col("day").between(day(first), day(last))), ["k"], "v", "id")
        merged = statistics.merged_range(spark, root, "day", ["k"], day(first), day(last))
        assert found(merged) == found(wanted)
    files = commits.latest(spark, root).files(spark)
    assert files.groupBy("value").agg(F.count_distinct("file").alias("n")).where("n > 1").count() == 0
    chosen = commits.read_committed(spark, root, None, "day", [day(9)])
    assert 0 < len(chosen.inputFiles()) < files.select("file").distinct().count()


def test_a_store_without_rows(spark, tmp_path):
    root = str(tmp_path / "daily")
    none = spark.createDataFrame([], SCHEMA)
    with pytest.raises(ValueError, match="no version"):
        statistics.merged_range(spark, root, "day", ["k"], day(0), day(1))
    statistics.store_daily(none, root, "day", ["k"], "v", "id")
    assert found(statistics.merged_range(spark, root, "day", ["k"], day(0), day(1))) == []
