"""What was delivered, and what of it is new since a run that took it in."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakestrata import commits

MANIFEST = "path STRING, modified TIMESTAMP, bytes LONG, source STRING"
# With more changed files than this, taking in everything anew is the better plan.
MOST_CHANGED = 10_000


def delivered(spark: SparkSession, pattern: str, source: str) -> DataFrame:
    """(path, modified, bytes, source) of the files that match; no file is read."""
    try:
        files = spark.read.format("binaryFile").load(pattern)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)
    return files.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_size").alias("bytes"),
        F.lit(source).alias("source"),
    )


@dataclass
class Changes:
    """Files of a source against the manifest of the last run.

    ``added`` are to be read, ``dropped`` are those whose old rows are void: a file that was
    replaced is in both. ``everything`` says that there was no run before, or too many changes to name.
    """

    now: DataFrame
    added: list[str]
    dropped: list[str]
    everything: bool

    def __bool__(self) -> bool:
        return bool(self.added or self.dropped) or self.everything and not self.now.isEmpty()


def changes_since(spark: SparkSession, manifest: str, pattern: str, source: str) -> Changes:
    """Compares the files that match now with the manifest; size and time of a file tell whether it is the same."""
    now = delivered(spark, pattern, source)
    if commits.latest(spark, manifest) is None:
        return Changes(now, [], [], everything=True)
    before = commits.read_committed(spark, manifest, MANIFEST, "source")
    old = before.select("path", F.struct("modified", "bytes").alias("old"))
    new = now.select("path", F.struct("modified", "bytes").alias("new"))
    differing = new.join(old, "path", "full").where(~F.col("new").eqNullSafe(F.col("old")))
    marks = differing.select("path", F.col("new").isNotNull().alias("is"), F.col("old").isNotNull().alias("was"))
    rows = marks.limit(MOST_CHANGED + 1).collect()
    if len(rows) > MOST_CHANGED:
        return Changes(now, [], [], everything=True)
    return Changes(now, [r["path"] for r in rows if r["is"]], [r["path"] for r in rows if r["was"]], everything=False)


def remember(spark: SparkSession, manifest: str, changes: Changes) -> None:
    """Note what was taken in, after it was."""
    commits.commit(changes.now, manifest, "source")
    commits.release(spark, manifest)
