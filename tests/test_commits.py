import os

import pytest
from pyspark.sql import functions as F

from lakestrata import commits
from lakestrata.sinks import files

SCHEMA = "id LONG, day STRING"


def frame(spark, *pairs):
    return spark.createDataFrame(list(pairs), SCHEMA)


def read(spark, root, values=None):
    return sorted(map(tuple, commits.read_committed(spark, root, SCHEMA, "day", values).collect()), key=str)


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "table")


def test_a_commit_replaces_or_adds(spark, root):
    assert commits.latest(spark, root) is None and read(spark, root) == []
    commits.commit(frame(spark, (1, "a"), (2, "b"), (3, None)), root, "day")
    commits.commit(frame(spark, (4, "b")), root, "day", append=True)
    assert read(spark, root) == [(1, "a"), (2, "b"), (3, None), (4, "b")]
    assert read(spark, root, ["b", "x"]) == [(2, "b"), (4, "b")]
    assert read(spark, root, []) == []
    commits.commit(frame(spark, (5, "a")), root, "day")
    assert read(spark, root) == [(5, "a")]
    assert [v.number for v in commits.versions(spark, root)] == [1, 2, 3]


def test_a_version_without_rows(spark, root):
    commits.commit(frame(spark, (1, "a")), root, "day")
    commits.commit(frame(spark).where("false"), root, "day")
    assert read(spark, root) == [] and read(spark, root, ["a"]) == []
    commits.commit(frame(spark, (2, "a")), root, "day", append=True)
    assert read(spark, root) == [(2, "a")]


def test_only_files_with_the_values_are_opened(spark, root):
    rows = spark.range(4000).select("id", F.concat(F.lit("d"), (F.col("id") % 40).cast("string")).alias("day"))
    version = commits.commit(rows, root, "day")
    listed = version.files(spark)
    # Each value lies in one file, however the rows came.
    assert listed.count() == 40 and listed.select("file").distinct().count() > 2
    assert {r["rows"] for r in listed.collect()} == {100}
    chosen = commits.read_committed(spark, root, SCHEMA, "day", ["d7"])
    assert len(chosen.inputFiles()) == 1 and chosen.count() == 100


def test_readers_see_no_half_run(spark, root, monkeypatch):
    commits.commit(frame(spark, (1, "a")), root, "day")
    seen = []
    real = commits.create_file
    monkeypatch.setattr(commits, "create_file", lambda *a: (seen.append(read(spark, root)), real(*a)))
    commits.commit(frame(spark, (2, "a"), (3, "b")), root, "day")
    assert seen == [[(1, "a")]] and read(spark, root) == [(2, "a"), (3, "b")]


def test_a_run_that_dies_is_not_seen_and_goes_with_the_next(spark, root, monkeypatch):
    commits.commit(frame(spark, (1, "a")), root, "day")
    with monkeypatch.context() as broken:
        broken.setattr(commits, "create_file", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            commits.commit(frame(spark, (2, "a")), root, "day", append=True)
    assert read(spark, root) == [(1, "a")]
    commits.commit(frame(spark, (3, "a")), root, "day", append=True)
    assert read(spark, root) == [(1, "a"), (3, "a")]
    commits.release(spark, root)
    assert read(spark, root) == [(1, "a"), (3, "a")]
    assert len([n for n in os.listdir(root) if n.startswith("run=")]) == 2


def test_two_runs_cannot_take_one_number(spark, root, monkeypatch):
    commits.commit(frame(spark, (1, "a")), root, "day")
    old = commits.latest(spark, root)
    commits.commit(frame(spark, (2, "a")), root, "day")
    monkeypatch.setattr(commits, "latest", lambda *a: old)
    with pytest.raises(Exception, match="exist"):
        commits.commit(frame(spark, (3, "a")), root, "day")
    monkeypatch.undo()
    assert read(spark, root) == [(2, "a")]


def test_release_keeps_what_kept_versions_name(spark, root):
    for n in range(4):
        commits.commit(frame(spark, (n, "a")), root, "day", append=n % 2 == 1)
    commits.release(spark, root, keep=2)
    assert [v.number for v in commits.versions(spark, root)] == [3, 4]
    assert read(spark, root) == [(2, "a"), (3, "a")]
    assert len([n for n in os.listdir(root) if n.startswith("run=")]) == 2
    commits.release(spark, root)
    commits.release(spark, root + "-none")
    assert read(spark, root) == [(2, "a"), (3, "a")]


def test_small_data_is_dealt_out_and_large_data_rebalanced(spark, monkeypatch):
    rows = spark.range(1000).select("id", (F.col("id") % 50).alias("day"))
    assert files.clustered(rows, "day").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(files, "SMALL_BYTES", 0)
    assert "REBALANCE" in files.clustered(rows, "day")._jdf.queryExecution().executedPlan().toString()
