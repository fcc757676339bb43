"""Files and layers: raw deliveries carried to bronze and silver, partitions, discovery."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakestrata import commits, schemas
from lakestrata.layout import working_folder
from lakestrata.operators import REJECT_REASON, average_by, rows_by
from lakestrata.plans import changed, customers, profiles, run_all, sales
from lakestrata.queries.inputs import (
    CUSTOMERS_SQL,
    DUMPS,
    PROFILE_DAY,
    PROFILES_SQL,
    SALE_DAY_SQL,
    SALES_REJECT_SQL,
    SALES_SQL,
    TABLES,
    new_lake,
    single_precision,
    table,
)
from lakestrata.queries.registry import query
from lakestrata.sinks import write_csv, write_parquet, write_partitioned
from lakestrata.sources import (
    SOURCE_FILE,
    discover_parquet,
    discover_widened,
    read_csv_text,
    read_json_lines,
    read_parquet,
    read_partition_range,
    with_source_file,
)
from lakestrata.streaming import ingest_new_sales, refine_new_sales

BRONZE_SALES_SQL = f"""SELECT
    CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'x' ELSE '' END || o_custkey
      AS "CustomerId",
    CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '5-LOW' THEN strftime(sale_day, '%Y/%m/%d')
      ELSE strftime(sale_day, '%Y-%m-') || day(sale_day) END AS "PurchaseDate",
    o_orderpriority AS "Product",
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P' THEN amount || 'USD'
      WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'O' THEN NULL
      ELSE '$' || replace(amount, ',', ', ') END AS "Price",
    'arrival=' || strftime(sale_day, '%Y-%m-') || day(sale_day) AS folder
  FROM (SELECT *, {SALE_DAY_SQL} AS sale_day, format('{{:,.2f}}', o_totalprice) AS amount
        FROM orders) AS dated"""


@query(BRONZE_SALES_SQL)
def sales_raw_to_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dated CSV folders read as one; the folder is recovered from the source file."""
    lake = new_lake(spark, sf_dir)
    sales.raw_to_bronze(spark, lake)
    return sales.read_bronze(spark, lake).select(
        "CustomerId",
        "PurchaseDate",
        "Product",
        "Price",
        F.element_at(F.split(SOURCE_FILE, "/"), -2).alias("folder"),
    )


@query(SALES_SQL)
def sales_raw_to_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = new_lake(spark, sf_dir)
    run_all.process_sales(spark, lake)
    return read_parquet(spark, lake.silver("sales"), schemas.SILVER_SALES)


@query(
    f"SELECT {SALES_REJECT_SQL} AS reject_reason, count(*) AS sales FROM orders "
    f"WHERE {SALES_REJECT_SQL} IS NOT NULL GROUP BY 1"
)
def sales_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = new_lake(spark, sf_dir)
    raw = read_csv_text(spark, lake.raw("sales/*/*.csv"), schemas.RAW_SALES)
    rejected = sales.rejected_sales(sales.bronze_sales(raw))
    return rows_by(rejected, [REJECT_REASON], "sales")


@query(
    f"SELECT count(*) AS rows_in, count(*) FILTER ({SALES_REJECT_SQL} IS NULL) AS rows_accepted "
    "FROM orders"
)
def sales_step_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts observed while silver was written, without a pass of their own."""
    lake = new_lake(spark, sf_dir)
    counts = run_all.process_sales(spark, lake)
    return spark.createDataFrame(
        [(counts["rows_in"], counts["rows_accepted"])], "rows_in BIGINT, rows_accepted BIGINT"
    )


@query(SALES_SQL)
def sales_in_daily_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same silver table from two runs that each take only new files."""
    lake, arriving = new_lake(spark), new_lake(spark, sf_dir)
    delivered = read_csv_text(spark, arriving.raw("sales/*/*.csv"), schemas.RAW_SALES)
    early = F.col("_metadata.file_path").contains("arrival=199")
    for year_range, chosen in (("early", early), ("late", ~early)):
        # Text is passed on as it is, blanks included.
        delivered.where(chosen).write.options(
            header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        ).csv(lake.raw(f"sales/{year_range}"))
        ingest_new_sales(spark, lake)
        refine_new_sales(spark, lake)
    return read_parquet(spark, lake.silver("sales"), schemas.SILVER_SALES)


@query(SALES_SQL)
def sales_by_changed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same silver table from two runs, the second over files that were replaced or added since the first."""
    lake, arriving = new_lake(spark), new_lake(spark, sf_dir)
    given = read_csv_text(spark, arriving.raw("sales/*/*.csv"), schemas.RAW_SALES)
    year = F.regexp_extract("_metadata.file_path", "arrival=([0-9]+)", 1).cast("int")

    def deliver(rows: DataFrame, name: str) -> None:
        rows.write.mode("overwrite").options(
            header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        ).csv(lake.raw(f"sales/{name}"))

    deliver(given.where(year < 1998), "early")
    # Wrong prices and days at first; some of these rows are then of days that the right ones do not have.
    deliver(given.where(year == 1998).withColumns({"Price": F.lit("$1"), "PurchaseDate": F.lit("1990-01-1")}), "middle")
    changed.update_sales(spark, lake)
    deliver(given.where(year == 1998), "middle")
    deliver(given.where(year > 1998), "late")
    changed.update_sales(spark, lake)
    return read_parquet(spark, lake.silver("sales"), schemas.SILVER_SALES)


@query(CUSTOMERS_SQL)
def customers_dumps_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping dumps; every client as the newest dump that holds it says."""
    lake = new_lake(spark, sf_dir)
    customers.raw_to_bronze(spark, lake)
    customers.bronze_to_silver(spark, lake)
    return read_parquet(spark, lake.silver("customers"), schemas.SILVER_CUSTOMERS)


@query(CUSTOMERS_SQL)
def customers_dumps_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from dumps merged one by one, out of order and one of them twice."""
    lake = new_lake(spark, sf_dir)
    first, second, third = DUMPS
    for dump in (second, third, first, second):
        customers.apply_dump(spark, lake, dump)
    return read_parquet(spark, lake.silver("customers"), schemas.SILVER_CUSTOMERS)


@query(
    "SELECT 'no email' AS reject_reason, count(*) AS customers FROM customer "
    "WHERE c_acctbal < 0 AND c_mktsegment IN ('AUTOMOBILE', 'BUILDING')"
)
def customers_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the first dump that are left out, by reason."""
    lake = new_lake(spark, sf_dir)
    path = lake.raw(f"customers/{next(iter(DUMPS))}")
    raw = read_csv_text(spark, path, schemas.RAW_CUSTOMERS)
    rejected = customers.rejected_customers(customers.bronze_customers(raw))
    return rows_by(rejected, [REJECT_REASON], "customers")


@query(
    "SELECT 'no email' AS reject_reason, count(*) AS profiles FROM customer "
    "WHERE c_mktsegment = 'FURNITURE' UNION ALL "
    "SELECT 'malformed line', count(*) FROM customer WHERE c_mktsegment = 'MACHINERY'"
)
def profiles_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles without an address, and lines cut off in the middle, by reason."""
    lake = new_lake(spark)
    profile_lines(spark, sf_dir).write.text(lake.raw("user_profiles/part.json"))
    profiles.raw_to_bronze(spark, lake)
    bronze = read_parquet(spark, lake.bronze("user_profiles"), profiles.BRONZE)
    return rows_by(profiles.rejected_profiles(bronze), [REJECT_REASON], "profiles")


def profile_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as JSON lines with a field that no schema names; some are cut off."""
    whole = F.to_json(
        F.struct(
            F.when(F.col("c_mktsegment") != "FURNITURE", F.concat(F.col("c_custkey").cast("string"), F.lit("@x.com")))
            .alias("email"),
            F.col("c_name").alias("full_name"),
            F.col("c_acctbal").alias("balance"),
        )
    )
    cut = F.when(F.col("c_mktsegment") == "MACHINERY", F.substring(whole, 1, 20)).otherwise(whole)
    return table(spark, sf_dir, "customer").select(cut.alias("value"))


@query(
    "SELECT c_custkey || '@x.com' AS email, c_acctbal AS balance FROM customer "
    "WHERE c_mktsegment NOT IN ('FURNITURE', 'MACHINERY')"
)
def profiles_bronze_keeps_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field unknown when bronze was written can still be read from its lines."""
    lake = new_lake(spark)
    profile_lines(spark, sf_dir).write.text(lake.raw("user_profiles/part.json"))
    profiles.raw_to_bronze(spark, lake)
    bronze = read_parquet(spark, lake.bronze("user_profiles"), profiles.BRONZE)
    good = bronze.where(F.col("email").isNotNull() & ~F.col(profiles.MALFORMED))
    return good.select("email", F.get_json_object(profiles.LINE, "$.balance").cast("double").alias("balance"))


EMPTIED = dt.date(1997, 9, 3)


@query(f"SELECT * FROM ({SALES_SQL}) AS s WHERE purchase_date <> DATE '{EMPTIED}'")
def sales_day_emptied_by_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day whose bronze rows are all unusable by now is gone after its replay."""
    lake = new_lake(spark, sf_dir)
    run_all.process_sales(spark, lake)
    price = F.when(F.col(sales.BRONZE_DAY) == F.lit(EMPTIED), "no price").otherwise(F.col("Price"))
    broken = sales.read_bronze(spark, lake).withColumn("Price", price)
    commits.commit(broken, lake.bronze("sales"), sales.BRONZE_DAY)
    sales.replay_days(spark, lake, [EMPTIED])
    return read_parquet(spark, lake.silver("sales"), schemas.SILVER_SALES)


@query(PROFILES_SQL)
def profiles_raw_to_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = new_lake(spark, sf_dir)
    profiles.raw_to_bronze(spark, lake)
    profiles.bronze_to_silver(spark, lake, F.lit(PROFILE_DAY).cast("date"))
    return read_parquet(spark, lake.silver("user_profiles"), schemas.SILVER_PROFILES)


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def json_lines_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = working_folder(spark, "json-lines")
    table(spark, sf_dir, "customer").write.json(path)
    return read_json_lines(spark, path, TABLES["customer"])


@query("SELECT e.event_id, e.event_type, true AS has_file FROM events AS e")
def parquet_scan_with_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = working_folder(spark, "events")
    write_parquet(table(spark, sf_dir, "events"), path)
    # The shared folder may be named with or without a scheme.
    folder = path.rstrip("/").rpartition("/")[2]
    found = F.col(SOURCE_FILE).endswith(".parquet") & F.col(SOURCE_FILE).contains(f"/{folder}/")
    return with_source_file(read_parquet(spark, path)).select(
        "event_id", "event_type", found.alias("has_file")
    )


FIRST, LAST = dt.date(1997, 9, 1), dt.date(1998, 2, 28)
DAY_SQL = "CAST(o_orderdate AS DATE)"


def orders_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.col("o_orderdate").cast("date").alias("day")
    )


@query(
    f"SELECT o_orderkey, o_totalprice, {DAY_SQL} AS day FROM orders "
    f"WHERE {DAY_SQL} BETWEEN DATE '{FIRST}' AND DATE '{LAST}'"
)
def partition_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = working_folder(spark, "orders-by-day")
    write_partitioned(orders_by_day(spark, sf_dir), path, "day")
    return read_partition_range(spark, path, "day", FIRST, LAST)


@query(
    f"""SELECT o_orderkey, CASE WHEN {DAY_SQL} BETWEEN DATE '{FIRST}' AND DATE '{LAST}'
      THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, {DAY_SQL} AS day FROM orders"""
)
def partition_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days of six months are written again with other prices; all others stay."""
    path = working_folder(spark, "orders-replayed")
    days = orders_by_day(spark, sf_dir)
    write_partitioned(days, path, "day")
    again = days.where(F.col("day").between(FIRST, LAST)).withColumn(
        "o_totalprice", F.col("o_totalprice") + 1
    )
    write_partitioned(again, path, "day", replay=True)
    return read_parquet(spark, path, "o_orderkey BIGINT, o_totalprice DOUBLE, day DATE")


@query(
    "SELECT p_type, CAST(CAST(avg(p_retailprice) AS REAL) AS DOUBLE) AS avg_price "
    "FROM part GROUP BY p_type"
)
def csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = working_folder(spark, "csv")
    averages = average_by(table(spark, sf_dir, "part"), ["p_type"], "p_retailprice", "avg_price")
    write_csv(averages.orderBy("p_type"), path)
    back = spark.read.csv(path, "p_type STRING, avg_price DOUBLE", header=True)
    return back.withColumn("avg_price", single_precision("avg_price"))


@query(
    """SELECT p_partkey, p_name, CASE WHEN p_size > 25 THEN p_brand END AS p_brand,
      CASE WHEN p_size <= 25 THEN p_type END AS p_type,
      CASE WHEN p_size > 25 THEN 'large' ELSE 'small' END AS batch FROM part"""
)
def schema_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two partition folders with different columns read as one table."""
    path = working_folder(spark, "parts-merged")
    parts, large = table(spark, sf_dir, "part"), F.col("p_size") > 25
    parts.where(large).select("p_partkey", "p_name", "p_brand").write.parquet(f"{path}/batch=large")
    parts.where(~large).select("p_partkey", "p_type", "p_name").write.parquet(f"{path}/batch=small")
    return discover_parquet(spark, path)


@query(
    """SELECT p_partkey, CAST(p_size AS DOUBLE) AS p_size, CASE WHEN p_size > 40 THEN p_brand END AS p_brand,
      CAST(p_retailprice AS DECIMAL(14,3)) AS price,
      CASE WHEN p_size > 40 THEN 'large' WHEN p_size > 20 THEN 'medium' ELSE 'small' END AS batch FROM part"""
)
def schema_widened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three folders that hold the same columns in types of different width, read as one table."""
    path = working_folder(spark, "parts-widened")
    parts, size = table(spark, sf_dir, "part"), F.col("p_size")
    price = F.col("p_retailprice")
    for name, chosen, columns in (
        ("small", size <= 20, [F.col("p_partkey").cast("int"), size, price.cast("decimal(10,2)").alias("price")]),
        ("medium", (size > 20) & (size <= 40), ["p_partkey", size.cast("double"), price.cast("decimal(13,2)").alias("price")]),
        ("large", size > 40, ["p_partkey", size.cast("smallint"), "p_brand", price.cast("decimal(12,3)").alias("price")]),
    ):
        parts.where(chosen).select(*columns).write.parquet(f"{path}/batch={name}")
    return discover_widened(spark, path)


@query("SELECT p_partkey, p_name FROM part")
def hidden_files_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leftovers of unfinished jobs lie among the files and are not read."""
    path = working_folder(spark, "parts-visible")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    parts.write.parquet(path)
    for leftover in ("_temporary", ".spark-staging", "_old"):
        parts.write.parquet(f"{path}/{leftover}")
    return discover_parquet(spark, path, "*.parquet")
