import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from lakestrata import sources
from lakestrata.sources import widening


def kind(text):
    return T._parse_datatype_string(f"c {text}")[0].dataType


@pytest.mark.parametrize("one,two,wanted", [
    ("int", "bigint", "bigint"), ("tinyint", "smallint", "smallint"), ("smallint", "double", "double"), ("float", "double", "double"),
    ("bigint", "double", None), ("float", "int", None), ("date", "timestamp_ntz", "timestamp_ntz"), ("date", "timestamp", None),
    ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"), ("decimal(38,0)", "decimal(38,10)", None), ("string", "int", None), ("void", "string", "string"),
    ("array<int>", "array<bigint>", "array<bigint>"), ("array<int>", "int", None), ("map<string,int>", "map<string,double>", "map<string,double>"),
    ("struct<a:int,b:string>", "struct<b:string,c:date,a:bigint>", "struct<a:bigint,b:string,c:date>"), ("struct<a:int>", "struct<a:string>", None),
])
def test_wider(spark, one, two, wanted):
    for a, b in ((one, two), (two, one)):
        found = widening.wider(kind(a), kind(b))
        if wanted is None:
            assert found is None
        elif wanted.startswith("struct"):
            assert {f.name: f.dataType for f in found} == {f.name: f.dataType for f in kind(wanted)}
        else:
            assert found == kind(wanted)


def write(spark, path, sql):
    spark.sql(sql).coalesce(1).write.mode("append").parquet(path)


def test_values_survive_widening(spark, tmp_path):
    root = str(tmp_path / "t")
    write(spark, f"{root}/day=1", "SELECT 1 AS i, 2147483647 AS n, CAST(1.5 AS FLOAT) AS f, DATE '2020-02-29' AS d, 1.25BD AS m")
    write(spark, f"{root}/day=2", "SELECT 2 AS i, 0.5D AS n, 2.25D AS f, TIMESTAMP_NTZ '2021-01-01 10:00:00' AS d, 12345678.5BD AS m")
    write(spark, f"{root}/day=3", "SELECT 9223372036854775807 AS i, CAST(NULL AS INT) AS n, 'x' AS extra")
    spark.sql("SELECT 'hidden' AS i").write.parquet(f"{root}/_old")
    found = sources.discover_widened(spark, root)
    assert sorted(map(tuple, found.select("day", "i", "n", "f", "d", "m", "extra").collect())) == [
        (1, 1, 2147483647.0, 1.5, dt.datetime(2020, 2, 29), Decimal("1.25"), None),
        (2, 2, 0.5, 2.25, dt.datetime(2021, 1, 1, 10), Decimal("12345678.50"), None),
        (3, 9223372036854775807, None, None, None, None, "x"),
    ]
    plan = found.where("day = 2 AND i > 1").select("f")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "GreaterThan(i,1)" in plan
    assert [r["f"] for r in found.where("i > 1 AND day < 3").collect()] == [2.25]


def test_conflicts_are_reported_by_path(spark, tmp_path):
    root = str(tmp_path / "t")
    for day in range(6):
        write(spark, f"{root}/day={day}", f"SELECT {day if day != 4 else repr('text')} AS c, 1 AS other")
    with pytest.raises(sources.TypeConflict, match=r"column c is int in \S*day=0 and string in \S*day=4"):
        sources.discover_widened(spark, root)


def test_files_of_one_folder_may_differ(spark, tmp_path):
    root = str(tmp_path / "t")
    write(spark, root, "SELECT 1 AS c")
    write(spark, root, "SELECT 2L AS c")
    write(spark, root, "SELECT 3 AS c")
    assert sorted(r["c"] for r in sources.discover_widened(spark, root, "*.parquet").collect()) == [1, 2, 3]
    write(spark, root, "SELECT 'x' AS c")
    with pytest.raises(sources.TypeConflict, match="part-"):
        sources.discover_widened(spark, root)


def test_few_looks_when_types_change_once(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    for day in range(16):
        write(spark, f"{root}/day={day:02}", f"SELECT {day}{'L' if day > 10 else ''} AS c")
    looks = []
    real = widening._reader
    monkeypatch.setattr(widening, "_reader", lambda *a: (looks.append(1), real(*a))[1])
    assert sources.discover_widened(spark, root).schema["c"].dataType == T.LongType()
    assert len(looks) <= 14  # of 16 folders, and one each to list and to scan


def test_types_that_agree_are_left_alone(spark, tmp_path):
    root = str(tmp_path / "t")
    write(spark, f"{root}/k=a", "SELECT 1 AS c")
    write(spark, f"{root}/k=b", "SELECT 2 AS c, 'x' AS d")
    assert sources.discover_widened(spark, root).schema == sources.discover_parquet(spark, root).schema
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        sources.discover_widened(spark, str(tmp_path / "none"))
