"""Rows scaled by the bounds of their group, kept up to date as rows arrive.

The bounds of every group are state, merged with those of each increment. Where they did not move, only the new
rows are scaled and added; where they did, the group's older rows are scaled again. Rows are
clustered by group, so the others lie in files that stay as they are, but for those that share a file.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakestrata import commits
from lakestrata.layout import materialize
from lakestrata.operators import group_bounds, scale_between


@dataclass(frozen=True)
class ScaledTable:
    """``value`` of each row scaled into ``name`` between the bounds of its ``group``; files lie under ``root``."""

    root: str
    group: str
    value: str
    name: str

    @property
    def rows_root(self) -> str:
        return f"{self.root}/rows"

    @property
    def bounds_root(self) -> str:
        return f"{self.root}/bounds"

    def rows(self, spark: SparkSession) -> DataFrame:
        return commits.read_committed(spark, self.rows_root, None, self.group)

    def bounds(self, spark: SparkSession) -> DataFrame:
        """(group, low, high) of the rows so far."""
        return commits.read_committed(spark, self.bounds_root, None, self.group)

    def add(self, increment: DataFrame) -> DataFrame:
        """Add rows with the columns of the first increment; returns the groups whose bounds moved, new ones included.

        Rows are committed before bounds: a run that died in between finds its rows in the table, so the caller must
        not add them again; :meth:`repair` then takes the bounds from the rows.
        """
        spark = increment.sparkSession
        increment = materialize(increment, "increment")
        known = commits.latest(spark, self.rows_root) is not None
        fresh = group_bounds(increment, [self.group], self.value)
        if not known:
            bounds = materialize(fresh, "bounds")
            commits.commit(self._scaled(increment, bounds), self.rows_root, self.group)
            self._store(bounds)
            return bounds.select(self.group)
        before = self.bounds(spark)
        merged = before.unionByName(fresh).groupBy(self.group).agg(F.min("low").alias("low"), F.max("high").alias("high"))
        old = before.select(F.col(self.group).alias("_g"), F.struct("low", "high").alias("_old"))
        compared = merged.join(old, F.col(self.group).eqNullSafe(F.col("_g")), "left")
        moved = F.col("_old").isNull() | ~F.struct("low", "high").eqNullSafe(F.col("_old"))
        merged = materialize(compared.select(self.group, "low", "high", moved.alias("_moved")), "bounds")
        groups, bounds = merged.where("_moved").select(self.group), merged.drop("_moved")

        files = commits.latest(spark, self.rows_root).files(spark)
        changed = groups.select(F.col(self.group).alias("_g"))
        touched = files.join(changed, F.col("value").eqNullSafe(F.col("_g")), "left_semi").select("run", "file").distinct()
        touched = materialize(touched, "touched-files")
        # One row per file that holds rows of such groups.
        paths = [f"{self.rows_root}/run={r['run']}/{r['file']}" for r in touched.collect()]
        plain = increment
        kept = None
        if paths:
            there = spark.read.schema(self.rows(spark).schema).parquet(*paths)
            same = F.col(self.group).eqNullSafe(F.col("_g"))
            plain = there.join(changed, same, "left_semi").drop(self.name).unionByName(increment)
            kept = there.join(changed, same, "left_anti")
        rows = self._scaled(plain, bounds)
        rows = rows if kept is None else rows.unionByName(kept)
        commits.commit(rows, self.rows_root, self.group, append=True, without=touched)
        self._store(bounds)
        commits.release(spark, self.rows_root)
        return groups

    def repair(self, spark: SparkSession) -> None:
        """Take bounds and scaled values from all rows anew."""
        rows = materialize(self.rows(spark).drop(self.name), "all-rows")
        bounds = materialize(group_bounds(rows, [self.group], self.value), "bounds")
        commits.commit(self._scaled(rows, bounds), self.rows_root, self.group)
        self._store(bounds)
        commits.release(spark, self.rows_root)

    def _scaled(self, rows: DataFrame, bounds: DataFrame) -> DataFrame:
        return scale_between(rows, bounds, self.value, [self.group], self.name)

    def _store(self, bounds: DataFrame) -> None:
        commits.commit(bounds, self.bounds_root, self.group)
        commits.release(bounds.sparkSession, self.bounds_root)
