"""Session settings the jobs are designed for. Every one may be overridden by spark-submit."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Runtime re-planning: coalesce small partitions, split skewed join sides
    # and skewed rebalance partitions, broadcast by measured size.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    # Fewer, larger scan tasks: 100 TB is 400,000 of them.
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}


# Shuffles start with this many partitions and AQE merges them to the advisory size; one row per
# key cannot be cut again later. For a cluster only: small local runs gain nothing from it.
CLUSTER_SETTINGS = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000"}


def build_session(app_name: str, **extra: str) -> SparkSession:
    """A session with :data:`SETTINGS`, plus ``extra`` given as ``key__with__dots``."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    session = builder.getOrCreate()
    if not session.conf.get("spark.master", "").startswith("local"):
        for key, value in CLUSTER_SETTINGS.items():
            if session.conf.get(key, None) is None:
                session.conf.set(key, value)
    return session
