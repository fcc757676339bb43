"""The business question on lineitem, orders and part, with nations as states."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakestrata.layout import Layout, working_folder
from lakestrata.plans import by_client
from lakestrata.plans.question import purchases_by_state, sales_in_window, top_states
from lakestrata.queries.inputs import BIRTH_SQL, birth_date, table
from lakestrata.queries.registry import query

PRODUCT = "ECONOMY"
FIRST, LAST = dt.date(1997, 9, 1), dt.date(1997, 9, 10)


def sale_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("product_name"))
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_custkey").alias("client_id"),
        F.col("o_orderdate").cast("date").alias("purchase_date"),
    )
    # Orders first: a date window leaves far fewer lines than a product does.
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).join(
        parts, lines.l_partkey == parts.p_partkey
    ).select("product_name", "client_id", "purchase_date")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("client_id"),
            F.col("n_name").alias("state"),
            birth_date().alias("birth_date"),
        )
    )


JOINED_SQL = f"""lineitem
  JOIN part ON l_partkey = p_partkey AND p_type = '{PRODUCT}'
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey"""
DECADE_SQL = "month(o_orderdate) = 9 AND day(o_orderdate) BETWEEN 1 AND 10"
RANGE_SQL = f"CAST(o_orderdate AS DATE) BETWEEN DATE '{FIRST}' AND DATE '{LAST}'"
AGE_SQL = f"date_diff('year', {BIRTH_SQL}, CAST(o_orderdate AS DATE)) BETWEEN 20 AND 30"


def states_sql(where: str, k: int | None = None) -> str:
    top = f" ORDER BY purchases DESC, state LIMIT {k}" if k else ""
    return (
        f"SELECT n_name AS state, count(*) AS purchases FROM {JOINED_SQL} "
        f"WHERE {where} GROUP BY n_name{top}"
    )


@query(states_sql(DECADE_SQL, 1))
def top_state_product_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_states(
        sale_lines(spark, sf_dir), users(spark, sf_dir), PRODUCT, month=9, days=(1, 10)
    )


@query(states_sql(f"{DECADE_SQL} AND {AGE_SQL}", 1))
def top_state_with_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_states(
        sale_lines(spark, sf_dir), users(spark, sf_dir), PRODUCT, (20, 30), month=9, days=(1, 10)
    )


@query(states_sql(f"{RANGE_SQL} AND {AGE_SQL}", 5))
def top_states_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_states(
        sale_lines(spark, sf_dir), users(spark, sf_dir), PRODUCT, (20, 30), 5, first=FIRST, last=LAST
    )


@query(states_sql(f"{DECADE_SQL} AND {AGE_SQL}"))
def purchases_by_state_in_age_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = sales_in_window(sale_lines(spark, sf_dir), PRODUCT, month=9, days=(1, 10))
    return purchases_by_state(chosen, users(spark, sf_dir), (20, 30))


@query(
    f"SELECT p_type AS product_name, o_custkey AS client_id, CAST(o_orderdate AS DATE) AS purchase_date "
    f"FROM lineitem JOIN part ON l_partkey = p_partkey AND p_type = '{PRODUCT}' "
    f"JOIN orders ON l_orderkey = o_orderkey WHERE {RANGE_SQL}"
)
def sales_of_product_in_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_in_window(sale_lines(spark, sf_dir), PRODUCT, first=FIRST, last=LAST)


@query(states_sql(f"{RANGE_SQL.replace(str(LAST), '1998-02-28')} AND {AGE_SQL}", 5))
def top_states_by_client(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six months of the question from sales counted and laid out by client."""
    lake, database = Layout(working_folder(spark, "lake")), f"g_{uuid.uuid4().hex}"
    by_client.load_by_client(
        spark,
        lake,
        sale_lines(spark, sf_dir).withColumn("client_id", F.col("client_id").cast("int")),
        users(spark, sf_dir).withColumn("client_id", F.col("client_id").cast("int")),
        database,
        buckets=8,
    )
    window = {"first": FIRST, "last": dt.date(1998, 2, 28)}
    return by_client.top_states_by_client(spark, database, PRODUCT, (20, 30), 5, **window)
