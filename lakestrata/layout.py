"""Where things live: lake directories, and shared working folders for one run."""

from __future__ import annotations

import functools
import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Layout:
    """Directory convention of a lake: ``<root>/<layer>/<table>``.

    ``deliveries`` may name another root under which the raw files lie.
    """

    root: str
    deliveries: str | None = None

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def raw(self, table: str) -> str:
        return f"{(self.deliveries or self.root).rstrip('/')}/raw/{table}"

    def bronze(self, table: str) -> str:
        return self.path("bronze", table)

    def silver(self, table: str) -> str:
        return self.path("silver", table)

    def gold(self, table: str) -> str:
        return self.path("gold", table)

    def warehouse(self, database: str) -> str:
        return self.path("warehouse", f"{database}.db")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    A machine-local folder is accepted only for a local master, where the
    driver and the executors are one process.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_folder()


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="lakestrata-")


def working_folder(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other call has used."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    This cuts the lineage in a way that outlives executors, and gives the
    optimiser a true size for the result: a later join broadcasts it when it is
    under ``spark.sql.autoBroadcastJoinThreshold`` and shuffles it otherwise.
    """
    path = working_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    jvm = spark._jvm
    found = jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def folder_exists(spark: SparkSession, path: str) -> bool:
    files, as_path = _file_system(spark, path)
    return files.exists(as_path(path))


def delete_folder(spark: SparkSession, path: str) -> None:
    files, as_path = _file_system(spark, path)
    files.delete(as_path(path), True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none when there is no folder."""
    files, as_path = _file_system(spark, path)
    if not files.exists(as_path(path)):
        return []
    return [found.getPath().getName() for found in files.listStatus(as_path(path))]


def create_file(spark: SparkSession, path: str, text: str) -> None:
    """A new small file, and the folder for it; fails when there is one of this name already."""
    files, as_path = _file_system(spark, path)
    out = files.create(as_path(path), False)
    out.write(bytearray(text.encode()))
    out.close()


def read_file(spark: SparkSession, path: str) -> str:
    files, as_path = _file_system(spark, path)
    stream = files.open(as_path(path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def swap_folder(spark: SparkSession, complete: str, target: str) -> None:
    """Put the complete folder in the place of ``target``; both on one file system.

    The old folder is moved aside and removed last. A run that dies in between
    leaves it, and the next call that finds no ``target`` takes it back first.
    """
    files, as_path = _file_system(spark, target)
    restore_folder(spark, target)
    files.mkdirs(as_path(target).getParent())
    aside = as_path(f"{target}.replaced")
    files.delete(aside, True)
    if files.exists(as_path(target)):
        files.rename(as_path(target), aside)
    if not files.rename(as_path(complete), as_path(target)):
        raise RuntimeError(f"could not move {complete} to {target}")
    files.delete(aside, True)


def restore_folder(spark: SparkSession, target: str) -> None:
    """Take back what a swap that died had moved aside."""
    files, as_path = _file_system(spark, target)
    aside = as_path(f"{target}.replaced")
    if files.exists(aside) and not files.exists(as_path(target)):
        files.rename(aside, as_path(target))
