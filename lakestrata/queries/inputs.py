"""Stand-ins for the lake's sources, derived row by row from the supplied tables.

Sales come from ``orders``, customers and profiles from ``customer``, nested
food documents from ``lineitem``. Dirt is put in by rules on ordinary columns;
the SQL beside each rule states what must be left after cleaning.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakestrata.layout import Layout, working_folder
from lakestrata.sources import read_parquet


# Column types of the supplied tables; stating them saves a job per table read.
TABLES = {
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": (
        "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
    ),
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": (
        "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
        "p_retailprice DOUBLE"
    ),
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
        "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
        "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"
    ),
    "events": (
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
        "props STRING"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet", TABLES[name])


_DELIVERED: dict[tuple[str, str], object] = {}


def delivered(spark: SparkSession, sf_dir: str) -> Layout:
    """All raw files made from one set of tables, written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _DELIVERED:
        lake = Layout(working_folder(spark, "deliveries"))
        for write in (write_sales, write_customers, write_profiles):
            write(spark, sf_dir, lake)
        _DELIVERED[key] = lake
    return _DELIVERED[key]


def deliver_food_lines(spark: SparkSession, sf_dir: str) -> str:
    """Path of the documents as JSON Lines, written once per application."""
    key = (spark.sparkContext.applicationId, f"{sf_dir} food")
    if key not in _DELIVERED:
        _DELIVERED[key] = write_food_lines(spark, sf_dir)
    return _DELIVERED[key]


def new_lake(spark: SparkSession, sf_dir: str | None = None) -> Layout:
    """An empty lake; with the raw files of a set of tables if these are named."""
    root = working_folder(spark, "lake")
    return Layout(root, delivered(spark, sf_dir).root if sf_dir else None)


def single_precision(name: str) -> Column:
    """A float average to the digits that do not depend on the order of its additions."""
    return F.col(name).cast("float").cast("double")


def lenient_day(day: Column) -> Column:
    """``2022-09-1``: the day of the month without a leading zero."""
    return F.concat(F.date_format(day, "yyyy-MM-"), F.dayofmonth(day).cast("string"))


# --- birth dates -------------------------------------------------------------

BIRTH_SQL = "(DATE '1960-01-01' + CAST(floor(c_acctbal) AS INTEGER))"


def birth_date() -> Column:
    return F.date_add(F.lit("1960-01-01").cast("date"), F.floor("c_acctbal").cast("int"))


# --- sales -------------------------------------------------------------------

# A sale counts on the day of its order.
SALE_DAY_SQL = "CAST(o_orderdate AS DATE)"

# Orders whose sale is made unreadable, and why; first match counts.
SALES_REJECT_SQL = """CASE
    WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'bad client_id'
    WHEN o_orderstatus = 'F' AND o_orderpriority = '5-LOW' THEN 'bad purchase_date'
    WHEN o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED' THEN 'bad price'
    WHEN o_orderstatus = 'O' AND o_orderpriority = '4-NOT SPECIFIED' THEN 'bad price'
  END"""

SALES_SQL = f"""SELECT o_orderpriority AS product_name, CAST(o_custkey AS INTEGER) AS client_id,
    CAST(o_totalprice AS DECIMAL(12,2)) AS price, {SALE_DAY_SQL} AS purchase_date
  FROM orders WHERE {SALES_REJECT_SQL} IS NULL"""


def sales_text(orders: DataFrame) -> DataFrame:
    """Orders as the text of a sales file, some of it unusable."""
    day = F.col("o_orderdate").cast("date")
    low = F.col("o_orderpriority") == "5-LOW"
    unspecified = F.col("o_orderpriority") == "4-NOT SPECIFIED"
    status = F.col("o_orderstatus")
    key = F.col("o_custkey").cast("string")
    amount = F.format_number("o_totalprice", 2)
    return orders.select(
        F.when(low & (status == "P"), F.concat(F.lit("x"), key))
        .otherwise(F.concat(key, F.lit(" ")))
        .alias("CustomerId"),
        F.when(low & (status == "F"), F.date_format(day, "yyyy/MM/dd"))
        .otherwise(lenient_day(day))
        .alias("PurchaseDate"),
        F.concat(F.lit(" "), "o_orderpriority", F.lit("  ")).alias("Product"),
        F.when(unspecified & (status == "P"), F.concat(amount, F.lit("USD")))
        .when(unspecified & (status == "O"), F.lit(None))
        .otherwise(F.concat(F.lit(" $"), F.replace(amount, F.lit(","), F.lit(", "))))
        .alias("Price"),
        lenient_day(day).alias("arrival"),
    )


def write_text_csv(df: DataFrame, path: str, by: str | None = None) -> None:
    writer = df.write.options(
        header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    if by is not None:
        writer = writer.partitionBy(by)
    writer.csv(path)


def write_sales(spark: SparkSession, sf_dir: str, lake: Layout) -> None:
    """Sales files, one folder per day."""
    rows = sales_text(table(spark, sf_dir, "orders"))
    write_text_csv(rows.hint("rebalance", F.col("arrival")), lake.raw("sales"), "arrival")


# --- customers ---------------------------------------------------------------

# Dump day -> market segments in it. Every dump repeats earlier ones, but for
# AUTOMOBILE, which the last dump has lost. The last day sorts first as text.
DUMPS = {
    "2022-8-1": ("AUTOMOBILE", "BUILDING"),
    "2022-8-5": ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"),
    "2022-8-10": ("BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"),
}

# Customers in debt have a blank address, machinery firms no first name and
# household ones no state.
CUSTOMERS_SQL = """SELECT CAST(c_custkey AS INTEGER) AS client_id,
    CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_name END AS first_name,
    CASE WHEN c_mktsegment <> 'BUILDING' THEN 'Family ' || c_nationkey END AS last_name,
    'cust' || c_custkey || '@example.com' AS email,
    DATE '2015-01-01' + c_nationkey * 40 AS registration_date,
    CASE WHEN c_mktsegment <> 'HOUSEHOLD'
      THEN c_nationkey || CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN '/2022-8-5'
                               ELSE '/2022-8-10' END END AS state
  FROM customer WHERE c_acctbal >= 0"""


def customers_text(customer: DataFrame, dump: str) -> DataFrame:
    """One dump of the customers as text; the state names the dump it is from."""
    segment, key = F.col("c_mktsegment"), F.col("c_custkey").cast("string")
    registered = F.date_add(F.lit("2015-01-01").cast("date"), F.col("c_nationkey") * 40)
    return customer.where(segment.isin(*DUMPS[dump])).select(
        key.alias("ClientId"),
        F.when(segment == "MACHINERY", "  ").otherwise(F.col("c_name")).alias("FirstName"),
        F.when(segment != "BUILDING", F.concat(F.lit("Family "), F.col("c_nationkey").cast("string")))
        .alias("LastName"),
        F.when(F.col("c_acctbal") < 0, "   ")
        .otherwise(F.concat(F.lit(" Cust"), key, F.lit("@Example.COM ")))
        .alias("Email"),
        lenient_day(registered).alias("RegistrationDate"),
        F.when(segment == "HOUSEHOLD", " ")
        .otherwise(F.concat(F.col("c_nationkey").cast("string"), F.lit(f"/{dump}")))
        .alias("State"),
    )


def write_customers(spark: SparkSession, sf_dir: str, lake: Layout) -> None:
    customer = table(spark, sf_dir, "customer")
    for dump in DUMPS:
        write_text_csv(customers_text(customer, dump), lake.raw(f"customers/{dump}"))


# --- profiles ----------------------------------------------------------------

PROFILE_DAY = "2001-09-10"

# Furniture firms have no profile address, the state of an automobile firm is
# blank and people of nation 0 have an unreadable birth date.
PROFILES_SQL = f"""SELECT 'cust' || c_custkey || '@example.com' AS email,
    'Given' || c_custkey || ' Van Name' || c_nationkey AS full_name,
    CASE WHEN c_nationkey <> 0 THEN {BIRTH_SQL} END AS birth_date,
    CASE WHEN c_nationkey <> 0 THEN
      CAST(date_sub('year', {BIRTH_SQL}, DATE '{PROFILE_DAY}') AS INTEGER) END AS age,
    CASE WHEN c_mktsegment <> 'AUTOMOBILE' THEN n_name END AS state,
    '555-' || c_custkey AS phone_number
  FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_mktsegment <> 'FURNITURE'"""


def profiles_text(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Customers as profile records; building firms come twice."""
    segment, key = F.col("c_mktsegment"), F.col("c_custkey").cast("string")
    nation_key = F.col("c_nationkey")
    copies = F.when(segment == "BUILDING", F.array(F.lit(1), F.lit(2))).otherwise(
        F.array(F.lit(1))
    )
    born = F.date_format(birth_date(), "yyyy-MM-dd")
    return (
        customer.join(nation, nation_key == F.col("n_nationkey"))
        .withColumn("copy", F.explode(copies))
        .select(
            F.when(segment != "FURNITURE", F.concat(F.lit("CUST"), key, F.lit("@example.com ")))
            .alias("email"),
            F.concat(
                F.lit("Given"), key, F.lit(" Van Name"), nation_key.cast("string")
            ).alias("full_name"),
            F.when(segment == "AUTOMOBILE", " ").otherwise(F.col("n_name")).alias("state"),
            F.when(nation_key == 0, "bad").otherwise(born).alias("birth_date"),
            F.concat(F.lit(" 555-"), key, F.lit(" ")).alias("phone_number"),
        )
    )


def write_profiles(spark: SparkSession, sf_dir: str, lake: Layout) -> None:
    rows = profiles_text(table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation"))
    rows.write.json(lake.raw("user_profiles"))


# --- nested food documents ---------------------------------------------------

# A line item becomes a document of two foods: its amounts (returned lines have
# no date, open ones of them no price) and its rates (no date; none when open).
FLAT_FOODS_SQL = """SELECT l_orderkey AS "fdcId", 'line ' || l_linenumber AS description,
      l_returnflag AS "dataType", l_linestatus AS "foodCategory",
      CASE WHEN l_returnflag <> 'R' THEN strftime(l_shipdate, '%Y-%m-%d') END AS "publishedDate",
      'quantity ' || l_suppkey AS "nutrientName", l_quantity AS "nutrientValue",
      'pcs' AS "nutrientUnit" FROM lineitem
    UNION ALL SELECT l_orderkey, 'line ' || l_linenumber, l_returnflag, l_linestatus,
      CASE WHEN l_returnflag <> 'R' THEN strftime(l_shipdate, '%Y-%m-%d') END,
      'price ' || l_suppkey,
      CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN NULL ELSE l_extendedprice END, 'usd'
      FROM lineitem
    UNION ALL SELECT l_partkey, 'rates', 'rate', l_linestatus, 'unknown', 'discount', l_discount,
      'part' FROM lineitem WHERE l_linestatus <> 'O'
    UNION ALL SELECT l_partkey, 'rates', 'rate', l_linestatus, 'unknown', 'tax ' || l_suppkey, l_tax,
      'part' FROM lineitem WHERE l_linestatus <> 'O'"""

DERIVED_FOODS_SQL = f"""SELECT *, year(TRY_CAST("publishedDate" AS DATE)) AS "publicationYear"
    FROM ({FLAT_FOODS_SQL}) AS flat"""


def food_documents(lineitem: DataFrame) -> DataFrame:
    """One document per line item, built from that row alone."""
    supplier = F.col("l_suppkey").cast("string")
    returned, still_open = F.col("l_returnflag") == "R", F.col("l_linestatus") == "O"

    def nutrient(name: Column, value: Column, unit: str) -> Column:
        return F.struct(
            name.alias("nutrientName"), value.alias("value"), F.lit(unit).alias("unitName")
        )

    def food(identity: str, text: Column, kind: Column, day: Column, nutrients: Column) -> Column:
        return F.struct(
            F.col(identity).alias("fdcId"),
            text.alias("description"),
            kind.alias("dataType"),
            F.col("l_linestatus").alias("foodCategory"),
            day.alias("publishedDate"),
            nutrients.alias("foodNutrients"),
        )

    price = F.when(~(returned & still_open), F.col("l_extendedprice"))
    amounts = F.array(
        nutrient(F.concat(F.lit("quantity "), supplier), F.col("l_quantity"), "pcs"),
        nutrient(F.concat(F.lit("price "), supplier), price, "usd"),
    )
    rates = F.array(
        nutrient(F.lit("discount"), F.col("l_discount"), "part"),
        nutrient(F.concat(F.lit("tax "), supplier), F.col("l_tax"), "part"),
    )
    shipped = F.when(~returned, F.date_format("l_shipdate", "yyyy-MM-dd"))
    foods = F.array(
        food(
            "l_orderkey",
            F.concat(F.lit("line "), F.col("l_linenumber").cast("string")),
            F.col("l_returnflag"),
            shipped,
            amounts,
        ),
        food(
            "l_partkey",
            F.lit("rates"),
            F.lit("rate"),
            F.lit("unknown"),
            F.when(still_open, F.slice(rates, 1, 0)).otherwise(rates),
        ),
    )
    return lineitem.select(foods.alias("foods"))


# The text of a document is many times its row, so deliveries are compressed. A compressed file is
# one task of the reader, so its documents are bounded.
COMPRESSION = "gzip"
LINES_PER_FILE = 1_000_000


def write_food_lines(spark: SparkSession, sf_dir: str) -> str:
    """The documents as JSON Lines."""
    path = working_folder(spark, "food-lines")
    writer = food_documents(table(spark, sf_dir, "lineitem")).write
    writer.option("maxRecordsPerFile", LINES_PER_FILE).json(path, compression=COMPRESSION)
    return path


# Rows of a whole-file document at most.
DOCUMENT_ROWS = 65_536


def _arrays(rows: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One row per so many lines of a task, as the text of a JSON array. A local function, so that workers need no package."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[str] = []
        for batch in batches:
            for line in batch.column("line").to_pylist():
                waiting.append(line)
                if len(waiting) == rows:
                    yield pa.RecordBatch.from_pydict({"value": ["[" + ",\n".join(waiting) + "]"]})
                    waiting.clear()
        if waiting:
            yield pa.RecordBatch.from_pydict({"value": ["[" + ",\n".join(waiting) + "]"]})

    return run


def deliver_food_files(spark: SparkSession, sf_dir: str) -> str:
    """The documents as files of one top-level array each, of bounded length.

    Each task strings its own lines together, so no text is shuffled and a task holds one file's text.
    """
    path = working_folder(spark, "food-files")
    lines = food_documents(table(spark, sf_dir, "lineitem")).select(F.to_json(F.struct("foods")).alias("line"))
    files = lines.mapInArrow(_arrays(DOCUMENT_ROWS), "value string")
    files.write.option("maxRecordsPerFile", 1).text(path, compression=COMPRESSION)
    return path
