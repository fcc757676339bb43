import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lakestrata import operators as op
from lakestrata.layout import materialize


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def skewed(spark):
    """Two thirds of the rows share a key; some keys and values are NULL."""
    rng = random.Random(7)
    data = [
        (i, rng.choice(["hot", "hot", "hot", "hot", "a", "b", "c", None]), rng.choice([None, 1.5, 2.0, 9.25]))
        for i in range(3000)
    ]
    return data, spark.createDataFrame(data, "i INT, k STRING, v DOUBLE").repartition(7)


def test_keep_latest_matches_brute_force(skewed):
    data, df = skewed
    wanted = {}
    for i, k, v in data:
        if k not in wanted or (v or 0, i) > (wanted[k][2] or 0, wanted[k][0]):
            wanted[k] = (i, k, v)
    found = op.keep_latest(df, ["k"], [F.col("v")])
    assert rows(found) == sorted(wanted.values(), key=repr)


def test_keep_latest_reduces_before_the_shuffle(skewed):
    plan = op.keep_latest(skewed[1], ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange hashpartitioning") < plan.index("partial_max")
    assert plan.count("Exchange hashpartitioning") == 1 and "Window" not in plan


def test_keep_latest_with_keys_only(spark):
    df = spark.createDataFrame([(1,), (1,), (None,)], "k INT")
    assert rows(op.keep_latest(df, ["k"])) == [(1,), (None,)]


def test_drop_duplicate_keys_does_not_depend_on_partitioning(skewed):
    df = skewed[1]
    once = rows(op.drop_duplicate_keys(df, ["k"]))
    assert once == rows(op.drop_duplicate_keys(df.repartition(3, "v"), ["k"]))
    assert len(once) == 5


def test_minmax_normalize_matches_window_rules(skewed):
    data, df = skewed
    found = {r["i"]: r["n"] for r in op.minmax_normalize(df, "v", ["k"], "n").collect()}
    assert len(found) == len(data)
    for i, k, v in data:
        group = [x for _, kk, x in data if kk == k and x is not None]
        low, high = min(group), max(group)
        wanted = 0.0 if high == low else None if v is None else (v - low) / (high - low)
        assert found[i] == wanted


def test_minmax_normalize_does_not_shuffle_rows_when_bounds_are_small(skewed):
    scaled = op.minmax_normalize(skewed[1], "v", ["k"], "n")
    plan = scaled._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning(k" not in plan


def test_minmax_normalize_without_broadcast(spark, skewed):
    df = skewed[1]
    wanted = rows(op.minmax_normalize(df, "v", ["k"], "n"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows(op.minmax_normalize(df, "v", ["k"], "n")) == wanted
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_minmax_without_spread_or_values(spark):
    df = spark.createDataFrame(
        [("one", 5.0), ("one", 5.0), ("none", None), ("int", 1.0), ("int", 3.0)], "k STRING, v DOUBLE"
    )
    found = rows(op.minmax_normalize(df, "v", ["k"], "n"))
    assert found == [
        ("int", 1.0, 0.0), ("int", 3.0, 1.0), ("none", None, 0.0), ("one", 5.0, 0.0), ("one", 5.0, 0.0)
    ]


def test_left_fill_keeps_every_left_row(spark):
    left = spark.createDataFrame(
        [(1, "a", None, "L"), (2, "a", "x", None), (3, None, None, None), (4, "z", None, None)],
        "id INT, key STRING, name STRING, state STRING",
    )
    right = spark.createDataFrame(
        [("a", "n1", "R", 10), ("a", "n0", "Q", 9), (None, "bad", "bad", 1), ("b", "n", "S", 2)],
        "key STRING, name STRING, state STRING, age INT",
    )
    found = op.left_fill(
        left,
        right,
        "key",
        {"name": ["left.name", "right.name"], "state": ["right.state", "left.state"]},
        ["age"],
    )
    assert found.columns == ["id", "key", "name", "state", "age"]
    assert rows(found) == [
        (1, "a", "n1", "R", 10), (2, "a", "x", "R", 10), (3, None, None, None, None), (4, "z", None, None, None)
    ]


def test_left_fill_with_a_hot_key_and_no_broadcast(spark):
    left = spark.range(4000).select(
        "id", F.when(F.col("id") < 3000, "hot").otherwise(F.col("id").cast("string")).alias("key"),
        F.lit(None).cast("string").alias("name"),
    )
    right = spark.range(4000).select(
        F.when(F.col("id") == 0, "hot").otherwise(F.col("id").cast("string")).alias("key"),
        F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"),
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1kb",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2kb",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        joined = op.left_fill(left.repartition(16), right, "key", {"name": ["left.name", "right.name"]})
        found = {r["id"]: r["name"] for r in joined.collect()}
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert found == {i: "n0" if i < 3000 else f"n{i}" for i in range(4000)}
    assert "skew=true" in plan


def test_upsert_modes(spark):
    schema = "id INT, a STRING, b INT"
    target = spark.createDataFrame([(1, "x", 1), (2, "y", 2), (3, "z", 3)], schema)
    changes = spark.createDataFrame(
        [(2, None, 20, 1), (2, "Y", None, 2), (4, "new", 4, 1), (None, "lost", 0, 1)],
        schema + ", at INT",
    )
    newest = [F.col("at")]
    filled = op.upsert(target, changes, ["id"], newest)
    assert rows(filled) == [(1, "x", 1), (2, "Y", 2), (3, "z", 3), (4, "new", 4)]
    replaced = op.upsert(target, changes, ["id"], newest, keep_when_null=False)
    assert rows(replaced) == [(1, "x", 1), (2, "Y", None), (3, "z", 3), (4, "new", 4)]
    assert rows(op.upsert(filled, changes, ["id"], newest)) == rows(filled)
    for keep in (True, False):
        two, one = (
            op.upsert(target.unionByName(target.select(F.lit(None).cast("int").alias("id"), "a", "b")),
                      changes, ["id"], ["at"], keep_when_null=keep, many_changes=many)
            for many in (False, True)
        )
        assert rows(two) == rows(one) and len(rows(one)) == 7


def test_named_marks_are_carried_once(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 7, "b"), (2, None, "c")], "k INT, at INT, t STRING")
    found = op.keep_latest(df, ["k"], ["at"])
    assert rows(found) == [(1, 7, "b"), (2, None, "c")] and found.columns == df.columns
    assert "_newest" not in found._jdf.queryExecution().toString()


def test_rejects_and_accepted_add_up(spark):
    df = spark.createDataFrame([(1, None), (None, None), (2, 3)], "a INT, b INT")
    marked = op.mark_rejects(df, {"no a": F.col("a").isNull(), "no b": F.col("b").isNull()})
    assert rows(op.rejected_rows(marked)) == [(1, None, "no b"), (None, None, "no a")]
    assert rows(op.accepted_rows(marked)) == [(2, 3)]


def test_quality(spark):
    df = spark.createDataFrame([(1, "abc"), (1, None), (None, "abcdef")], "k INT, t STRING")
    counts = op.quality_counts(df, ["k", "t"], {"t": 4}).first().asDict()
    assert counts == {
        "rows_in": 3, "rows_accepted": 1, "k_missing": 1, "t_missing": 1, "t_too_wide": 1
    }
    assert rows(op.duplicate_keys(df, ["k"])) == [(1, 2)]
    assert rows(op.too_wide(df, {"t": 4})) == [(None, "abcdef")]


def test_top_k_breaks_ties(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 1)], "s STRING, n INT")
    assert [tuple(r) for r in op.top_k(df, "n", 1, ["s"]).collect()] == [("a", 2)]


def test_trim_strings_leaves_other_types_and_tabs(spark):
    df = spark.createDataFrame([(1, " x\t", " y ")], "a INT, b STRING, c STRING")
    assert rows(op.trim_strings(df, skip=["c"])) == [(1, "x\t", " y ")]


def test_materialize_keeps_rows_and_schema(spark, skewed):
    df = skewed[1]
    copy = materialize(df, "copy")
    assert copy.schema == df.schema and rows(copy) == rows(df)
    assert materialize(df.limit(0), "empty").count() == 0


def test_one_exchange_of_sales_answers_a_date_range(spark, tmp_path):
    from lakestrata.plans import question

    first, last = dt.date(2021, 12, 1), dt.date(2022, 2, 28)
    days = F.date_add(F.lit("2021-12-01").cast("date"), (F.col("id") % 90).cast("int"))
    sales = spark.range(3000).select(
        F.lit("TV").alias("product_name"), (F.col("id") % 97).cast("int").alias("client_id"), days.alias("purchase_date")
    )
    users = spark.range(100).select(
        F.col("id").cast("int").alias("client_id"), (F.col("id") % 5).cast("string").alias("state"),
        F.make_date(F.lit(1985) + (F.col("id") % 25).cast("int"), F.lit(6), F.lit(1)).alias("birth_date"),
    )
    paths = [str(tmp_path / n) for n in ("sales", "users")]
    for df, path in zip((sales, users), paths):
        df.write.parquet(path)
    sales, users = (spark.read.parquet(p) for p in paths)
    chosen = question.sales_in_window(sales, "TV", first=first, last=last)
    ranged = question.purchases_by_state(chosen, users, (20, 30), range(2021, 2023))
    assert rows(ranged) == rows(question.purchases_by_state(chosen, users, (20, 30)))
    plan = ranged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(client_id") <= 2 and "_year" not in plan
