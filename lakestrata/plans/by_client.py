"""The question's tables laid out by client, so that neither its count nor its join shuffles the sales.

Sales are counted per client, product and day, and written in buckets of the client beside the users in the same
buckets. A client with a third of all sales then has as many rows as products and days, so its bucket stays
small, and the counts of a client meet the user where both lie.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakestrata import catalog, publishing
from lakestrata.layout import Layout
from lakestrata.operators import top_k
from lakestrata.plans.gold import reconcile
from lakestrata.plans.question import sales_in_window
from lakestrata.sinks import observed
from lakestrata.sources import read_table

COUNTS, USERS = "sales_counts", "users_by_client"
COUNT_COLUMNS = "client_id INT, product_name VARCHAR(512), purchase_date DATE, purchases BIGINT"
USER_COLUMNS = "client_id INT, state VARCHAR(50), birth_date DATE"
BUCKETS = 200


def client_counts(sales: DataFrame) -> DataFrame:
    """Purchases per client, product and day."""
    keys = ["client_id", "product_name", "purchase_date"]
    return sales.groupBy(*keys).agg(F.count(F.lit(1)).alias("purchases"))


def load_by_client(
    spark: SparkSession,
    lake: Layout,
    sales: DataFrame,
    users: DataFrame,
    database: str = "gold",
    buckets: int = BUCKETS,
    keep: int = 1,
) -> None:
    """Write both tables in ``buckets`` buckets of client_id and publish them.

    Choose about one bucket per 256 MB of counts. Both tables must have the same number.
    """
    warehouse = lake.warehouse(database)
    catalog.create_database(spark, database, warehouse)
    ready = {}
    for table, columns, rows in ((COUNTS, COUNT_COLUMNS, client_counts(sales)), (USERS, USER_COLUMNS, users)):
        publishing.adopt(spark, database, table)
        version = publishing.new_version(spark, database, table, columns, warehouse, buckets=("client_id", buckets))
        # One task per bucket, so a bucket is one file.
        counted, counts = observed(rows.repartition(buckets, "client_id"), f"{table}_rows")
        catalog.insert_by_name(counted, database, version, overwrite=True)
        reconcile(counts.get["rows"], read_table(spark, database, version))
        ready[table] = version
    for table, version in ready.items():
        publishing.publish(spark, database, table, version)
        publishing.release(spark, database, table, warehouse, keep)


def top_states_by_client(
    spark: SparkSession,
    database: str,
    product: str,
    ages: tuple[int, int] | None = None,
    k: int = 1,
    **window,
) -> DataFrame:
    """What :func:`question.top_states` answers, from the tables by client; the only exchange is that of states."""
    counts = sales_in_window(read_table(spark, database, COUNTS), product, **window)
    year = F.year("purchase_date")
    per_client = counts.groupBy("client_id", year.alias("_year")).agg(F.sum("purchases").alias("_purchases"))
    joined = per_client.join(read_table(spark, database, USERS), "client_id")
    if ages is not None:
        joined = joined.where((F.col("_year") - F.year("birth_date")).between(*ages))
    states = joined.groupBy("state").agg(F.sum("_purchases").alias("purchases"))
    return top_k(states, "purchases", k, ["state"])
