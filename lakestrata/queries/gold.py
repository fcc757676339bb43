"""Catalog tables, enrichment, gold loads, and the whole run from raw files to the answer."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakestrata import catalog, schemas
from lakestrata.layout import Layout, materialize, working_folder
from lakestrata.operators import duplicate_keys, too_wide, upsert
from lakestrata.plans import customers, gold, profiles, run_all, sales
from lakestrata.queries.inputs import (
    CUSTOMERS_SQL,
    PROFILE_DAY,
    PROFILES_SQL,
    SALES_SQL,
    new_lake,
    table,
)
from lakestrata.queries.registry import query
from lakestrata.sinks import write_parquet, write_partitioned
from lakestrata.sources import read_csv_text, read_json_lines, read_parquet, read_table

def as_of() -> Column:
    return F.lit(PROFILE_DAY).cast("date")



def fresh_database(kind: str) -> str:
    return f"{kind}_{uuid.uuid4().hex}"


def silver_frames(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Silver customers and profiles straight from delivered files."""
    lake = new_lake(spark, sf_dir)
    dumps = read_csv_text(spark, lake.raw("customers/*/*.csv"), schemas.RAW_CUSTOMERS)
    records = read_json_lines(spark, lake.raw("user_profiles/*.json"), schemas.RAW_PROFILES)
    return (
        customers.silver_customers(customers.bronze_customers(dumps)),
        profiles.silver_profiles(profiles.bronze_profiles(records), as_of()),
    )


def enriched_sql(first_name: str, last_name: str) -> str:
    return f"""SELECT c.client_id, {first_name} AS first_name, {last_name} AS last_name, c.email,
      c.registration_date, coalesce(p.state, c.state) AS state, p.birth_date, p.age, p.phone_number
    FROM ({CUSTOMERS_SQL}) AS c LEFT JOIN ({PROFILES_SQL}) AS p ON c.email = p.email"""


ENRICHED_SQL = enriched_sql(
    "coalesce(c.first_name, split_part(p.full_name, ' ', 1))",
    "coalesce(c.last_name, substr(p.full_name, strpos(p.full_name, ' ') + 1))",
)


@query(ENRICHED_SQL)
def enrich_left_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, known = silver_frames(spark, sf_dir)
    return gold.enrich_customers(found, known, as_of()).drop("updated_at")


@query(enriched_sql("coalesce(c.first_name, p.full_name)", "c.last_name"))
def enrich_verbatim_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, known = silver_frames(spark, sf_dir)
    enriched = gold.enrich_customers(found, known, as_of(), name_policy="verbatim")
    return enriched.drop("updated_at")


def silver_lake(spark: SparkSession, sf_dir: str) -> Layout:
    lake = new_lake(spark, sf_dir)
    run_all.process_customers(spark, lake)
    run_all.process_profiles(spark, lake, as_of())
    return lake


@query(f"SELECT *, TIMESTAMP '{PROFILE_DAY} 00:00:00' AS updated_at FROM ({ENRICHED_SQL}) AS e")
def gold_profiles_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver tables from the catalog, enriched, and loaded into the typed gold table."""
    lake, silver_db, gold_db = silver_lake(spark, sf_dir), fresh_database("s"), fresh_database("g")
    run_all.enrich(spark, lake, as_of(), silver_db, gold_db)
    stamp = F.col("updated_at").cast("timestamp_ntz")
    return read_table(spark, gold_db, "user_profiles_enriched").withColumn("updated_at", stamp)


FIRST, LAST = dt.date(1997, 9, 1), dt.date(1997, 10, 31)


def sales_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = new_lake(spark, sf_dir)
    raw = read_csv_text(spark, lake.raw("sales/*/*.csv"), schemas.RAW_SALES)
    return sales.silver_sales(sales.bronze_sales(raw))


@query(
    f"SELECT * FROM ({SALES_SQL}) AS s "
    f"WHERE purchase_date BETWEEN DATE '{FIRST}' AND DATE '{LAST}'"
)
def gold_sales_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two months of silver into the typed sales table; the second half is loaded twice."""
    lake, gold_db = new_lake(spark), fresh_database("g")
    write_partitioned(sales_frame(spark, sf_dir), lake.silver("sales"), "purchase_date")
    gold.load_gold_sales(spark, lake, FIRST, LAST, gold_db)
    middle = FIRST + (LAST - FIRST) / 2
    gold.load_gold_sales(spark, lake, middle, LAST, gold_db, append=True)
    return read_table(spark, gold_db, "sales")


NARROW_FIRST, NARROW_LAST = dt.date(1997, 9, 5), dt.date(1997, 9, 20)


@query(
    f"SELECT * FROM ({SALES_SQL}) AS s "
    f"WHERE purchase_date BETWEEN DATE '{NARROW_FIRST}' AND DATE '{NARROW_LAST}'"
)
def gold_sales_reloaded_narrower(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fresh load of fewer days leaves no older day in the table's directory."""
    lake, gold_db = new_lake(spark), fresh_database("g")
    write_partitioned(sales_frame(spark, sf_dir), lake.silver("sales"), "purchase_date")
    gold.load_gold_sales(spark, lake, FIRST, LAST, gold_db)
    gold.load_gold_sales(spark, lake, NARROW_FIRST, NARROW_LAST, gold_db)
    location = catalog.table_location(spark, gold_db, "sales")
    on_disk = read_parquet(spark, location, schemas.SILVER_SALES)
    # The directory is read, and the table must agree with it.
    assert on_disk.count() == read_table(spark, gold_db, "sales").count()
    return on_disk


@query(
    f"SELECT count(*) AS rows_in, count(DISTINCT client_id) AS clients, 0::BIGINT AS repeated, "
    f"0::BIGINT AS wide FROM ({ENRICHED_SQL}) AS e"
)
def gold_profiles_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the checks before a gold load find: nothing repeated, nothing too wide."""
    found, known = silver_frames(spark, sf_dir)
    enriched = materialize(gold.enrich_customers(found, known, as_of()), "enriched")
    gold.check_gold_profiles(enriched)
    return enriched.agg(
        F.count(F.lit(1)).alias("rows_in"), F.count_distinct("client_id").alias("clients")
    ).select(
        "*",
        F.lit(duplicate_keys(enriched, ["client_id"]).count()).cast("long").alias("repeated"),
        F.lit(too_wide(enriched, schemas.GOLD_PROFILE_WIDTHS).count()).cast("long").alias("wide"),
    )


@query(
    "SELECT o_orderkey, o_orderpriority, CAST(o_orderdate AS DATE) AS day FROM orders"
)
def catalog_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files by day registered as a table, dropped, registered again, and read by name."""
    location, database = working_folder(spark, "orders"), fresh_database("c")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", F.col("o_orderdate").cast("date").alias("day")
    )
    write_partitioned(rows, location, "day")
    catalog.create_database(spark, database, working_folder(spark, "database"))
    columns = "o_orderkey BIGINT, o_orderpriority STRING, day DATE"
    for _ in range(2):
        catalog.recreate_table(spark, database, "orders", columns, location, "day")
        catalog.refresh_partitions(spark, database, "orders")
    return read_table(spark, database, "orders")


@query(
    """SELECT p_partkey, p_name, CASE WHEN p_size > 25 THEN p_brand END AS p_brand,
      CASE WHEN p_size > 25 THEN 'large' ELSE 'small' END AS batch FROM part"""
)
def discovered_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table found by looking at its files, and found again when a folder was added."""
    location, database = working_folder(spark, "found"), fresh_database("c")
    parts, large = table(spark, sf_dir, "part"), F.col("p_size") > 25
    catalog.create_database(spark, database, working_folder(spark, "database"))
    parts.where(~large).select("p_partkey", "p_name").write.parquet(f"{location}/batch=small")
    catalog.discover_table(spark, database, "part", location)
    wider = parts.where(large).select("p_partkey", "p_name", "p_brand")
    wider.write.parquet(f"{location}/batch=large")
    catalog.discover_table(spark, database, "part", location)
    return read_table(spark, database, "part")


@query("SELECT n_nationkey, n_name, c_custkey, c_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def insert_matches_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole directory loaded into a typed table whose columns are in another order."""
    source, database = working_folder(spark, "customers"), fresh_database("c")
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    joined = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    write_parquet(joined.select("c_name", "n_name", "c_custkey", "n_nationkey"), source)
    catalog.create_database(spark, database, working_folder(spark, "database"))
    columns = "n_nationkey INT, n_name VARCHAR(50), c_custkey BIGINT, c_name VARCHAR(255)"
    catalog.recreate_table(spark, database, "named", columns, working_folder(spark, "named"))
    catalog.insert_by_name(spark.read.parquet(source), database, "named", overwrite=True)
    return read_table(spark, database, "named")


@query(
    """SELECT s_suppkey, s_name || ' renamed' AS s_name, s_nationkey, s_acctbal FROM supplier
    WHERE s_acctbal >= 0 UNION ALL SELECT * FROM supplier WHERE s_acctbal < 0
    UNION ALL SELECT c_custkey + 1000000000, c_name, c_nationkey, c_acctbal FROM customer"""
)
def merged_into_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes merged into a catalogued table that is read and replaced in one step."""
    database = fresh_database("c")
    catalog.create_database(spark, database, working_folder(spark, "database"))
    columns = "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE"
    catalog.recreate_table(spark, database, "supplier", columns, working_folder(spark, "supplier"))
    supplier, customer = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "customer")
    catalog.insert_by_name(supplier, database, "supplier")
    renamed = supplier.where(F.col("s_acctbal") >= 0).withColumn(
        "s_name", F.concat("s_name", F.lit(" renamed"))
    )
    added = customer.select(
        (F.col("c_custkey") + 1_000_000_000).alias("s_suppkey"),
        F.col("c_name").alias("s_name"),
        F.col("c_nationkey").alias("s_nationkey"),
        F.col("c_acctbal").alias("s_acctbal"),
    )
    merged = upsert(
        read_table(spark, database, "supplier"), renamed.unionByName(added), ["s_suppkey"]
    )
    catalog.replace_contents(merged, database, "supplier", working_folder(spark, "supplier"))
    return read_table(spark, database, "supplier")


@query(
    """SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1995 THEN o_totalprice + 1 ELSE o_totalprice END
        AS o_totalprice,
      CASE WHEN year(o_orderdate) = 1997 AND o_orderstatus = 'P' THEN 1996 ELSE year(o_orderdate) END::INTEGER AS year
    FROM orders UNION ALL SELECT c_custkey + 1000000000, c_acctbal, 2030 FROM customer WHERE c_nationkey = 3"""
)
def merged_into_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes merged into a table by year: prices of one, orders that move to another, and a new one."""
    database = fresh_database("c")
    catalog.create_database(spark, database, working_folder(spark, "database"))
    columns = "o_orderkey BIGINT, o_totalprice DOUBLE, year INT"
    catalog.recreate_table(spark, database, "orders", columns, working_folder(spark, "orders"), "year")
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    by_year = orders.select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"), "o_orderstatus")
    catalog.insert_by_name(by_year.drop("o_orderstatus"), database, "orders", overwrite=True)
    dearer = by_year.where("year = 1995").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    # Without a price, the old one stays.
    moved = by_year.where("year = 1997 AND o_orderstatus = 'P'").withColumns(
        {"year": F.lit(1996), "o_totalprice": F.lit(None).cast("double")}
    )
    added = customer.where("c_nationkey = 3").select(
        (F.col("c_custkey") + 1_000_000_000).alias("o_orderkey"),
        F.col("c_acctbal").alias("o_totalprice"),
        F.lit(2030).alias("year"),
    )
    changes = dearer.unionByName(moved).drop("o_orderstatus").unionByName(added)
    catalog.merge_partitions(changes, database, "orders", ["o_orderkey"])
    return read_table(spark, database, "orders")


FULL_FIRST, FULL_LAST = dt.date(1997, 9, 1), dt.date(1998, 2, 28)


@query(
    f"""SELECT state, count(*) AS purchases FROM ({SALES_SQL}) AS s
    JOIN ({ENRICHED_SQL}) AS u ON s.client_id = u.client_id
    WHERE product_name = '1-URGENT'
      AND purchase_date BETWEEN DATE '{FULL_FIRST}' AND DATE '{FULL_LAST}'
      AND date_diff('year', birth_date, purchase_date) BETWEEN 20 AND 30
    GROUP BY state ORDER BY purchases DESC, state LIMIT 5"""
)
def raw_files_to_answer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every step in order: raw CSV and JSON to bronze, silver, gold and the top states."""
    lake = new_lake(spark, sf_dir)
    return run_all.run_all(
        spark,
        lake,
        "1-URGENT",
        FULL_FIRST,
        FULL_LAST,
        (20, 30),
        as_of(),
        fresh_database("s"),
        fresh_database("g"),
        k=5,
    )
