"""Scalar functions, projections and row filters, each over a whole table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakestrata.functions import (
    STRICT_DAY,
    blank_to_null,
    completed_years,
    level_bucket,
    normalize_email,
    parse_day,
    parse_int,
    parse_money,
    split_full_name,
    text_year,
    year_boundaries,
)
from lakestrata.operators import require_columns, trim_strings
from lakestrata.queries.inputs import BIRTH_SQL, birth_date, lenient_day, table
from lakestrata.queries.registry import query


@query("SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(12,2)) AS price FROM orders")
def money_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit(" $"), F.format_number("o_totalprice", 2), F.lit("\t"))
    return table(spark, sf_dir, "orders").select("o_orderkey", parse_money(text).alias("price"))


@query(
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN CAST(o_totalprice AS DECIMAL(12,2)) END "
    "AS price FROM orders"
)
def money_rejects_other_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    text = (
        F.when(F.col("o_orderstatus") == "O", amount)
        .when(F.col("o_orderstatus") == "P", F.concat(amount, F.lit(" EUR")))
        .otherwise("NaN")
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", parse_money(text).alias("price"))


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS purchase_date FROM orders")
def day_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = lenient_day(F.col("o_orderdate"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", parse_day(text).alias("purchase_date")
    )


@query(
    "SELECT c_custkey, CASE WHEN c_mktsegment <> 'BUILDING' "
    f"THEN {BIRTH_SQL} END AS birth_date FROM customer"
)
def strict_day_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(
        F.col("c_mktsegment") == "BUILDING", F.date_format(birth_date(), "dd.MM.yyyy")
    ).otherwise(F.date_format(birth_date(), "yyyy-MM-dd"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", parse_day(text, STRICT_DAY).alias("birth_date")
    )


@query(
    "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS INTEGER) END "
    "AS client_id FROM orders"
)
def int_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_custkey").cast("string")
    text = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("x"), key)).otherwise(key)
    return table(spark, sf_dir, "orders").select("o_orderkey", parse_int(text).alias("client_id"))


@query(
    "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN CAST(year(o_orderdate) AS INTEGER) END "
    "AS publication_year FROM orders"
)
def year_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("o_orderstatus") == "F", "unknown").otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd")
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", text_year(text).alias("publication_year")
    )


AGED_SQL = f"""SELECT o_orderkey, CAST({{age}} AS INTEGER) AS age
  FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS bought, {BIRTH_SQL} AS born
        FROM orders JOIN customer ON o_custkey = c_custkey) AS aged"""


def aged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    born = table(spark, sf_dir, "customer").select("c_custkey", birth_date().alias("born"))
    bought = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("bought")
    )
    return bought.join(born, bought.o_custkey == born.c_custkey)


@query(AGED_SQL.format(age="date_sub('year', born, bought)"))
def age_in_completed_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    age = completed_years(F.col("born"), F.col("bought"))
    return aged_orders(spark, sf_dir).select("o_orderkey", age.alias("age"))


@query(AGED_SQL.format(age="date_diff('year', born, bought)"))
def age_by_year_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    age = year_boundaries(F.col("born"), F.col("bought"))
    return aged_orders(spark, sf_dir).select("o_orderkey", age.alias("age"))


@query(
    "SELECT event_id, CASE WHEN event_type = 'error' THEN 'Low' WHEN value > 50 THEN 'High' "
    "WHEN value > 10 THEN 'Medium' ELSE 'Low' END AS level FROM events"
)
def level_of_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.when(F.col("event_type") != "error", F.col("value"))
    return table(spark, sf_dir, "events").select("event_id", level_bucket(value).alias("level"))


@query(
    "SELECT c_custkey, 'Given' || c_custkey AS first_name, "
    "CASE WHEN c_mktsegment <> 'BUILDING' THEN 'Van Name' || c_nationkey END AS last_name FROM customer"
)
def full_name_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = F.concat(F.lit(" Given"), F.col("c_custkey").cast("string"))
    family = F.concat(F.lit(" Van Name"), F.col("c_nationkey").cast("string"))
    text = F.when(F.col("c_mktsegment") == "BUILDING", given).otherwise(F.concat(given, family))
    first_name, last_name = split_full_name(text)
    return table(spark, sf_dir, "customer").select(
        "c_custkey", first_name.alias("first_name"), last_name.alias("last_name")
    )


@query(
    "SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN lower(c_name) || '@example.com' END AS email "
    "FROM customer"
)
def email_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("c_acctbal") < 0, "   ").otherwise(
        F.concat(F.lit("  "), F.upper("c_name"), F.lit("@Example.com "))
    )
    return table(spark, sf_dir, "customer").select(
        "c_custkey", normalize_email(text).alias("email")
    )


@query(
    "SELECT s_suppkey, CASE WHEN s_acctbal >= 0 THEN s_name END AS name FROM supplier"
)
def blank_is_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("s_acctbal") < 0, "  ").otherwise(F.concat(F.lit(" "), "s_name"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", blank_to_null(text).alias("name"))


@query("SELECT p_partkey, p_name, p_brand || chr(9) AS p_brand, p_type, p_size FROM part")
def all_strings_trimmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.concat(F.lit("  "), "p_name").alias("p_name"),
        F.concat("p_brand", F.lit("\t  ")).alias("p_brand"),
        F.concat(F.lit(" "), "p_type", F.lit(" ")).alias("p_type"),
        "p_size",
    )
    return trim_strings(padded)


@query(
    "SELECT p_partkey AS part_id, p_name AS product_name, "
    "CAST(p_retailprice AS DECIMAL(12,2)) AS price, p_size * 2 AS double_size FROM part"
)
def renamed_and_derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "part")
        .withColumnsRenamed({"p_partkey": "part_id", "p_name": "product_name"})
        .withColumns(
            {
                "price": F.round("p_retailprice", 2).cast("decimal(12,2)"),
                "double_size": F.expr("p_size * 2"),
            }
        )
        .drop("p_brand", "p_type", "p_size", "p_retailprice")
    )


@query(
    "SELECT event_id, value FROM events "
    "WHERE event_type <> 'error' AND user_id IS NOT NULL AND value IS NOT NULL"
)
def required_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.when(F.col("event_type") != "error", F.col("value"))
    gaps = table(spark, sf_dir, "events").select("event_id", "user_id", value.alias("value"))
    return require_columns(gaps, ["user_id", "value"]).select("event_id", "value")


@query(
    "SELECT event_id, event_type, value FROM events "
    "WHERE value > 10 AND value <= 50 AND event_type <> 'view'"
)
def value_comparisons(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.col("value")
    return (
        table(spark, sf_dir, "events")
        .where((value > 10) & (value <= 50) & (F.col("event_type") != "view"))
        .select("event_id", "event_type", "value")
    )


@query(
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders "
    "WHERE o_orderpriority = '1-URGENT' AND EXTRACT(MONTH FROM o_orderdate) = 9 "
    "AND EXTRACT(DAY FROM o_orderdate) BETWEEN 1 AND 10"
)
def first_decade_of_september(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .where(
            (F.col("o_orderpriority") == "1-URGENT")
            & (F.month("o_orderdate") == 9)
            & F.dayofmonth("o_orderdate").between(1, 10)
        )
        .select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    )


@query(
    "SELECT o_orderkey, o_totalprice FROM orders "
    "WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-09-01' AND DATE '1997-09-10'"
)
def closed_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return (
        table(spark, sf_dir, "orders")
        .where(day.between(dt.date(1997, 9, 1), dt.date(1997, 9, 10)))
        .select("o_orderkey", "o_totalprice")
    )


@query(
    f"SELECT o_orderkey, date_diff('year', {BIRTH_SQL}, CAST(o_orderdate AS DATE)) AS age "
    "FROM orders JOIN customer ON o_custkey = c_custkey "
    f"WHERE date_diff('year', {BIRTH_SQL}, CAST(o_orderdate AS DATE)) BETWEEN 20 AND 30"
)
def buyers_in_age_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    age = year_boundaries(F.col("born"), F.col("bought")).cast("bigint")
    return (
        aged_orders(spark, sf_dir)
        .select("o_orderkey", age.alias("age"))
        .where(F.col("age").between(20, 30))
    )
