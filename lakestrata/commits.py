"""Tables whose versions are told by commit lists.

A run writes its rows once, clustered by a column, into a folder of its own, and then a list of its files
with the values of that column in each. A version is a list; it counts from the moment its pointer, one
small file, exists. So readers see all of a run or nothing of it, a run that dies leaves files that
no list names, and rows of a few values are read from the files that hold them, without opening others.

::

    <root>/run=<run>/part-*.parquet
    <root>/_commits/<run>/            the list: run, file, value, rows
    <root>/_commits/<number>.version  the pointer, holding the name of the run

One run at a time may commit to a table; a second one that took the same number fails.
"""

from __future__ import annotations

import uuid
from collections.abc import Collection, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakestrata.layout import create_file, delete_folder, folder_names, read_file
from lakestrata.sinks.files import clustered

LISTS = "_commits"
POINTER = ".version"


@dataclass(frozen=True)
class Version:
    root: str
    number: int
    run: str

    @property
    def list_path(self) -> str:
        return f"{self.root}/{LISTS}/{self.run}"

    def files(self, spark: SparkSession) -> DataFrame:
        """(run, file, value, rows): one row per file and value in it."""
        return spark.read.parquet(self.list_path)


def _pointer(root: str, number: int) -> str:
    return f"{root}/{LISTS}/{number:010d}{POINTER}"


def versions(spark: SparkSession, root: str) -> list[Version]:
    """All committed versions, oldest first."""
    names = [n for n in folder_names(spark, f"{root}/{LISTS}") if n.endswith(POINTER)]
    numbers = sorted(int(n.removesuffix(POINTER)) for n in names)
    return [Version(root, n, read_file(spark, _pointer(root, n))) for n in numbers]


def latest(spark: SparkSession, root: str) -> Version | None:
    names = [n for n in folder_names(spark, f"{root}/{LISTS}") if n.endswith(POINTER)]
    if not names:
        return None
    number = max(int(n.removesuffix(POINTER)) for n in names)
    return Version(root, number, read_file(spark, _pointer(root, number)))


def commit(
    df: DataFrame, root: str, by: str, *, append: bool = False, without: DataFrame | None = None
) -> Version:
    """Write ``df`` clustered by the column ``by`` and make it the table's next version.

    ``append`` keeps the files of the version before, but for those listed in ``without`` (run, file). The rows are shuffled once, whatever the number of
    values; they are sorted inside a file, so row groups hold narrow ranges as well.
    """
    spark = df.sparkSession
    before = latest(spark, root)
    number = before.number + 1 if before else 1
    run = f"{number:010d}-{uuid.uuid4().hex}"
    folder = f"{root}/run={run}"
    clustered(df, by).sortWithinPartitions(by).write.parquet(folder)
    kind = df.schema[by].dataType.simpleString()
    written = spark.read.schema(f"`{by}` {kind}").parquet(folder)
    listed = written.groupBy(F.col("_metadata.file_name").alias("file"), F.col(by).alias("value")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    listed = listed.select(F.lit(run).alias("run"), "file", "value", "rows")
    if append and before:
        kept = before.files(spark)
        if without is not None:
            kept = kept.join(without, ["run", "file"], "left_anti")
        listed = listed.unionByName(kept)
    made = Version(root, number, run)
    listed.write.parquet(made.list_path)
    create_file(spark, _pointer(root, number), run)
    return made


def replace_values(df: DataFrame, root: str, by: str, values: Collection) -> Version:
    """A next version in which ``df`` has taken the place of all rows whose ``by`` is one of ``values``.

    Only the files that hold such rows are read, for the other rows in them. ``df`` may hold rows of ``values`` only.
    """
    spark, before, values = df.sparkSession, latest(df.sparkSession, root), list(values)
    if before is None:
        return commit(df, root, by)
    touched = before.files(spark).where(F.col("value").isin(values)).select("run", "file").distinct()
    paths = [f"{root}/run={r['run']}/{r['file']}" for r in touched.collect()]
    if paths:
        there = spark.read.schema(df.schema).parquet(*paths)
        df = df.unionByName(there.where(~F.col(by).isin(values) | F.col(by).isNull()))
    return commit(df, root, by, append=True, without=touched)


def read_committed(
    spark: SparkSession, root: str, schema: str | None, by: str, values: Sequence | None = None
) -> DataFrame:
    """Rows of the latest version; with ``values`` only those whose ``by`` is one of them.

    Then only files that hold such rows are opened. A table without a version has no rows. Without
    ``schema`` there must be a version, whose files tell it.
    """
    found = latest(spark, root)
    if found is None and schema is None:
        raise ValueError(f"no version at {root}")
    if found is None:
        return spark.createDataFrame([], schema)
    if schema is None:
        schema = spark.read.parquet(f"{root}/run={found.run}").schema
    listed = found.files(spark)
    if values is None:
        paths = []
        for run in sorted(runs_of(spark, found)):
            names = unlisted(spark, found, run)
            paths += [f"{root}/run={run}"] if not names else [f"{root}/run={run}/{n}" for n in files_of(spark, found, run)]
    else:
        listed = listed.where(F.col("value").isin(list(values))).select("run", "file").distinct()
        paths = [f"{root}/run={r['run']}/{r['file']}" for r in listed.collect()]
    if not paths:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(*paths)
    return rows if values is None else rows.where(F.col(by).isin(list(values)))


def runs_of(spark: SparkSession, version: Version) -> set[str]:
    """Runs that a version has files of; one row per run reaches the driver."""
    return {r["run"] for r in version.files(spark).select("run").distinct().collect()}


def files_of(spark: SparkSession, version: Version, run: str) -> list[str]:
    """Names of the files of one run that a version has; one row per file reaches the driver."""
    of_run = version.files(spark).where(F.col("run") == run)
    return sorted(r["file"] for r in of_run.select("file").distinct().collect())


def unlisted(spark: SparkSession, version: Version, run: str) -> list[str]:
    """Files in the folder of a run that the version does not have: a later commit left them out."""
    listed = set(files_of(spark, version, run))
    there = folder_names(spark, f"{version.root}/run={run}")
    return [n for n in there if n.endswith(".parquet") and n not in listed]


def release(spark: SparkSession, root: str, keep: int = 1) -> None:
    """Forget all but the last ``keep`` versions, and delete what no kept one names.

    Pointers go first, so a version that is being deleted is never the latest.
    """
    known = versions(spark, root)
    if not known:
        return
    kept, gone = known[-keep:], known[:-keep]
    for version in gone:
        delete_folder(spark, _pointer(root, version.number))
    lists = {v.run for v in kept}
    runs = {v.run: runs_of(spark, v) for v in kept}
    used = set().union(*runs.values())
    for name in folder_names(spark, root):
        if name != LISTS and name.removeprefix("run=") not in used | lists:
            delete_folder(spark, f"{root}/{name}")
    for run in used - lists:  # only a run before a kept version can have lost files to it
        nowhere = set.intersection(*({*unlisted(spark, v, run)} for v in kept if run in runs[v.run]))
        for name in nowhere:
            delete_folder(spark, f"{root}/run={run}/{name}")
    for name in folder_names(spark, f"{root}/{LISTS}"):
        if not name.endswith(POINTER) and name not in lists:
            delete_folder(spark, f"{root}/{LISTS}/{name}")
