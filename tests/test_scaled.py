import random

import pytest
from pyspark.sql import functions as F

from lakestrata import commits
from lakestrata import operators as op
from lakestrata.plans import scaled
from lakestrata.plans.scaled import ScaledTable

SCHEMA = "i LONG, g STRING, v DOUBLE"


@pytest.fixture
def table(tmp_path):
    return ScaledTable(str(tmp_path / "scaled"), "g", "v", "n")


def frame(spark, tmp_path, data, name):
    """Rows read from files, so that their size is known."""
    spark.createDataFrame(data, SCHEMA).write.parquet(str(tmp_path / name))
    return spark.read.schema(SCHEMA).parquet(str(tmp_path / name))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def check(spark, table, data):
    whole = op.minmax_normalize(spark.createDataFrame(data, SCHEMA), "v", ["g"], "n")
    assert rows(table.rows(spark)) == rows(whole)
    assert rows(table.bounds(spark)) == rows(op.group_bounds(spark.createDataFrame(data, SCHEMA), ["g"], "v"))


def test_increments_equal_a_full_pass(spark, tmp_path, table):
    rng = random.Random(5)
    data, at = [], 0
    for turn in range(4):
        more = [
            (at + n, rng.choice([None, *"abcdefgh"[: turn * 2 + 3]]), rng.choice([None, rng.gauss(0, turn + 1)])) for n in range(60)
        ]
        table.add(frame(spark, tmp_path, more, f"in{turn}"))
        data, at = data + more, at + 60
        check(spark, table, data)
    table.add(frame(spark, tmp_path, [], "none"))
    check(spark, table, data)


def test_only_groups_whose_bounds_moved_are_scaled_again(spark, tmp_path, table, monkeypatch):
    data = [(n, f"g{n % 50}", float(n)) for n in range(1000)]
    assert len(rows(table.add(frame(spark, tmp_path, data, "first")))) == 50
    files = commits.latest(spark, table.rows_root).files(spark)
    before = {r["file"]: r["groups"] for r in files.groupBy("file").agg(F.collect_set("value").alias("groups")).collect()}
    scaled_rows = []
    real = scaled.scale_between
    monkeypatch.setattr(scaled, "scale_between", lambda df, *a: (scaled_rows.append(df.count()), real(df, *a))[1])
    # g1 inside its bounds, g2 below them, a new group, and one without values.
    more = [(2000, "g1", 500.0), (2001, "g2", -5.0), (2002, "new", 1.0), (2003, "empty", None)]
    assert rows(table.add(frame(spark, tmp_path, more, "more"))) == [("empty",), ("g2",), ("new",)]
    assert scaled_rows == [20 + 4]
    after = {r["file"] for r in commits.latest(spark, table.rows_root).files(spark).select("file").distinct().collect()}
    assert len(before) > 2 and set(before) - after == {f for f, groups in before.items() if "g2" in groups}
    check(spark, table, data + more)


def test_a_run_that_died_is_repaired(spark, tmp_path, table, monkeypatch):
    data = [(n, f"g{n % 3}", float(n)) for n in range(30)]
    table.add(frame(spark, tmp_path, data, "first"))
    more = [(100, "g0", 99.0)]
    with monkeypatch.context() as broken:
        broken.setattr(ScaledTable, "_store", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            table.add(frame(spark, tmp_path, more, "more"))
    table.repair(spark)
    check(spark, table, data + more)
