"""Aggregation, deduplication, scaling, merging and quality checks on plain tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakestrata.functions import text_year
from lakestrata.layout import working_folder
from lakestrata.operators import (
    average_by,
    count_by,
    distinct_count_by,
    drop_duplicate_keys,
    duplicate_keys,
    estimates,
    group_bounds,
    keep_latest,
    median_by,
    minmax_normalize,
    quality_counts,
    rows_by,
    sum_by,
    too_wide,
    top_k,
    upsert,
)
from lakestrata.operators.sketches import DISTINCT_SIZE, RANK_ERROR
from lakestrata.plans import statistics
from lakestrata.plans.scaled import ScaledTable
from lakestrata.queries.inputs import single_precision, table
from lakestrata.queries.registry import query


@query(
    "SELECT event_type, user_id, CAST(CAST(avg(value) AS REAL) AS DOUBLE) AS avg_value "
    "FROM events GROUP BY ALL"
)
def average_by_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    averages = average_by(
        table(spark, sf_dir, "events"), ["event_type", "user_id"], "value", "avg_value"
    )
    return averages.withColumn("avg_value", single_precision("avg_value")).orderBy(
        "event_type", "user_id"
    )


@query(
    "SELECT l_suppkey, l_returnflag, quantile_disc(l_extendedprice, 0.5) AS median_price "
    "FROM lineitem GROUP BY ALL"
)
def median_by_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return median_by(
        table(spark, sf_dir, "lineitem"),
        ["l_suppkey", "l_returnflag"],
        "l_extendedprice",
        "median_price",
    ).orderBy("l_suppkey", "l_returnflag")


@query(
    "SELECT l_returnflag, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY l_returnflag"
)
def distinct_count_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return distinct_count_by(lines, ["l_returnflag"], "l_partkey", "parts").orderBy("l_returnflag")


@query(
    "SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) "
    "AS DECIMAL(22,2)) AS total FROM lineitem GROUP BY ALL"
)
def sum_by_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    exact = table(spark, sf_dir, "lineitem").withColumn(
        "l_extendedprice", F.col("l_extendedprice").cast("decimal(12,2)")
    )
    return sum_by(exact, ["l_returnflag", "l_linestatus"], "l_extendedprice", "total").orderBy(
        "l_returnflag", "l_linestatus"
    )


@query(
    "SELECT CASE WHEN o_orderstatus <> 'P' THEN CAST(year(o_orderdate) AS INTEGER) END AS order_year, "
    "count(CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderkey END) AS orders "
    "FROM orders GROUP BY 1"
)
def count_by_derived_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("o_orderstatus") != "P", F.date_format("o_orderdate", "yyyy-MM-dd"))
    key = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderkey"))
    orders = table(spark, sf_dir, "orders").select(
        text_year(text).alias("order_year"), key.alias("key")
    )
    return count_by(orders, ["order_year"], "key", "orders").orderBy("order_year")


SHIPPED_FIRST, SHIPPED_LAST, SHIPPED_AGAIN = dt.date(1996, 3, 1), dt.date(1998, 8, 31), dt.date(1997, 5, 5)
SHIPPED_SQL = f"CAST(l_shipdate AS DATE) BETWEEN DATE '{SHIPPED_FIRST}' AND DATE '{SHIPPED_LAST}'"


@query(
    f"""SELECT l_returnflag, count(*) AS rows, CAST(CAST(avg(l_extendedprice) AS REAL) AS DOUBLE) AS avg_price,
      true AS median_is_near, true AS parts_are_near FROM lineitem WHERE {SHIPPED_SQL} GROUP BY l_returnflag"""
)
def statistics_merged_from_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of a range from the sketches of its days, against a pass over its rows.

    The median is near when its rank is 0.5 within three times the stated error; distinct parts within three
    standard errors. One day was wrong at first and is replaced.
    """
    root, key = working_folder(spark, "daily-statistics"), "l_returnflag"
    lines = table(spark, sf_dir, "lineitem").withColumn("day", F.col("l_shipdate").cast("date"))
    again = F.col("day") == F.lit(SHIPPED_AGAIN)
    wrong = lines.withColumn("l_extendedprice", F.when(again, -1.0).otherwise(F.col("l_extendedprice")))
    columns = ("day", [key], "l_extendedprice", "l_partkey")
    statistics.store_daily(wrong, root, *columns)
    statistics.store_daily(lines.where(again), root, *columns, days=[SHIPPED_AGAIN])
    merged = statistics.merged_range(spark, root, "day", [key], SHIPPED_FIRST, SHIPPED_LAST)
    found = estimates(merged, {"median": 0.5}, "average", "parts")
    chosen = lines.where(F.col("day").between(SHIPPED_FIRST, SHIPPED_LAST))
    exact = chosen.join(F.broadcast(found.select(key, "median")), key).groupBy(key).agg(
        F.avg((F.col("l_extendedprice") < F.col("median")).cast("int")).alias("below"),
        F.avg((F.col("l_extendedprice") <= F.col("median")).cast("int")).alias("up_to"),
        F.count_distinct("l_partkey").alias("exact_parts"),
    )
    off = 3 * RANK_ERROR
    return found.join(exact, key).select(
        key,
        "rows",
        single_precision("average").alias("avg_price"),
        ((F.col("below") <= 0.5 + off) & (F.col("up_to") >= 0.5 - off)).alias("median_is_near"),
        (F.abs(F.col("parts") / F.col("exact_parts") - 1) <= 3 / DISTINCT_SIZE**0.5).alias("parts_are_near"),
    )


@query("SELECT c_nationkey, count(*) AS customers FROM customer GROUP BY c_nationkey")
def rows_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows_by(table(spark, sf_dir, "customer"), ["c_nationkey"], "customers")


@query("SELECT count(*) AS rows_in FROM lineitem")
def whole_table_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("rows_in"))


@query(
    "SELECT p_type, count(*) AS parts FROM part GROUP BY p_type ORDER BY parts DESC, p_type LIMIT 3"
)
def top_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(rows_by(table(spark, sf_dir, "part"), ["p_type"], "parts"), "parts", 3, ["p_type"])


@query(
    "SELECT event_id, ts, user_id, event_type, value, props FROM events "
    "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"
)
def latest_event_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_latest(table(spark, sf_dir, "events"), ["user_id"], ["ts"])


@query(
    "SELECT event_type, user_id, max(event_id) AS event_id FROM events GROUP BY event_type, user_id"
)
def one_event_per_type_and_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id")
    return drop_duplicate_keys(events, ["event_type", "user_id"])


@query("SELECT event_type, min(value) AS low, max(value) AS high FROM events GROUP BY event_type")
def bounds_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_bounds(table(spark, sf_dir, "events"), ["event_type"], "value")


SCALED_SQL = """SELECT event_id, event_type, value, CASE WHEN high - low <> 0
    THEN (value - low) / (high - low) ELSE 0.0 END AS scaled
  FROM (SELECT event_id, event_type, value, min(value) OVER w AS low, max(value) OVER w AS high
        FROM {source} WINDOW w AS (PARTITION BY event_type)) AS bounded"""


@query(SCALED_SQL.format(source="events"))
def scaled_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return minmax_normalize(events, "value", ["event_type"], "scaled")


@query(SCALED_SQL.format(source="events"))
def scaled_in_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from three arrivals; groups are scaled again where an arrival moves their bounds."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    kept = ScaledTable(working_folder(spark, "scaled-events"), "event_type", "value", "scaled")
    # Outliers come last, so that some bounds move with every arrival.
    middle, late = F.col("value").between(5, 50), F.pmod("event_id", F.lit(3)) == 0
    for arrival in (middle & ~late, middle & late, F.coalesce(~middle, F.lit(True))):
        kept.add(events.where(arrival))
    return kept.rows(spark).select("event_id", "event_type", "value", "scaled")


@query(
    SCALED_SQL.format(
        source="""(SELECT event_id, nullif(event_type, 'error') AS event_type,
          CASE WHEN event_type = 'view' THEN NULL WHEN event_type = 'click' THEN 7.5
               WHEN event_type = 'signup' AND value > 10 THEN NULL ELSE value END AS value
          FROM events) AS gaps"""
    )
)
def scaled_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A NULL group, a group without values, one without spread and one with some NULLs."""
    kind, value = F.col("event_type"), F.col("value")
    gaps = table(spark, sf_dir, "events").select(
        "event_id",
        F.nullif(kind, F.lit("error")).alias("event_type"),
        F.when(kind == "click", 7.5)
        .when((kind != "view") & ~((kind == "signup") & (value > 10)), value)
        .alias("value"),
    )
    return minmax_normalize(gaps, "value", ["event_type"], "scaled")


def supplier_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two generations of changes to suppliers, and as many new suppliers as customers."""
    supplier, customer = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "customer")
    debt = F.col("s_acctbal") < 0

    def changed(generation: int) -> DataFrame:
        return supplier.where(F.col("s_nationkey") < 12).select(
            F.when(F.col("s_nationkey") != 3, F.col("s_suppkey")).alias("s_suppkey"),
            F.concat("s_name", F.lit(f" v{generation}")).alias("s_name"),
            F.lit(None).cast("int").alias("s_nationkey"),
            F.when(~debt, F.col("s_acctbal") + generation).alias("s_acctbal"),
            F.lit(generation).alias("generation"),
        )

    new = customer.select(
        (F.col("c_custkey") + 1_000_000_000).alias("s_suppkey"),
        F.col("c_name").alias("s_name"),
        F.col("c_nationkey").alias("s_nationkey"),
        F.col("c_acctbal").alias("s_acctbal"),
        F.lit(1).alias("generation"),
    )
    return changed(1).unionByName(changed(2)).unionByName(new)


NEW_SUPPLIERS_SQL = (
    "UNION ALL SELECT c_custkey + 1000000000, c_name, c_nationkey, c_acctbal FROM customer"
)


@query(
    f"""SELECT s_suppkey,
      CASE WHEN s_nationkey < 12 AND s_nationkey <> 3 THEN s_name || ' v2' ELSE s_name END AS s_name,
      s_nationkey, CASE WHEN s_nationkey < 12 AND s_nationkey <> 3 AND s_acctbal >= 0
        THEN s_acctbal + 2 ELSE s_acctbal END AS s_acctbal FROM supplier {NEW_SUPPLIERS_SQL}"""
)
def upsert_filling(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = supplier_changes(spark, sf_dir)
    newest = [F.col("generation")]
    return upsert(table(spark, sf_dir, "supplier"), changes, ["s_suppkey"], newest)


@query(
    f"""SELECT s_suppkey,
      CASE WHEN s_nationkey < 12 AND s_nationkey <> 3 THEN s_name || ' v2' ELSE s_name END AS s_name,
      CASE WHEN s_nationkey >= 12 OR s_nationkey = 3 THEN s_nationkey END AS s_nationkey,
      CASE WHEN s_nationkey >= 12 OR s_nationkey = 3 THEN s_acctbal
           WHEN s_acctbal >= 0 THEN s_acctbal + 2 END AS s_acctbal FROM supplier {NEW_SUPPLIERS_SQL}"""
)
def upsert_replacing(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = supplier_changes(spark, sf_dir)
    newest = [F.col("generation")]
    return upsert(
        table(spark, sf_dir, "supplier"), changes, ["s_suppkey"], newest, keep_when_null=False
    )


@query(
    """SELECT count(*) AS rows_in, count(*) FILTER (o_orderstatus <> 'P') AS rows_accepted,
      CAST(0 AS BIGINT) AS o_orderkey_missing,
      count(*) FILTER (o_orderstatus = 'P') AS o_orderpriority_missing,
      count(*) FILTER (o_orderstatus <> 'P' AND length(o_orderpriority) > 8)
        AS o_orderpriority_too_wide FROM orders"""
)
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    gaps = table(spark, sf_dir, "orders").withColumn(
        "o_orderpriority", F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    )
    return quality_counts(gaps, ["o_orderkey", "o_orderpriority"], {"o_orderpriority": 8})


@query(
    "SELECT l_orderkey, count(*) AS copies FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1"
)
def repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey"])


@query("SELECT p_partkey, p_name FROM part WHERE length(p_name) > 10 OR length(p_type) > 7")
def over_wide_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    return too_wide(parts, {"p_name": 10, "p_type": 7}).select("p_partkey", "p_name")
