"""All steps in order, raw files to the answer; also a command line for single steps."""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakestrata.layout import Layout
from lakestrata.plans import changed, customers, food, gold, profiles, question, sales
from lakestrata.session import build_session
from lakestrata.sources import read_table


def process_sales(spark: SparkSession, lake: Layout) -> dict:
    sales.raw_to_bronze(spark, lake)
    return sales.bronze_to_silver(spark, lake).get


def process_customers(spark: SparkSession, lake: Layout) -> dict:
    customers.raw_to_bronze(spark, lake)
    return customers.bronze_to_silver(spark, lake).get


def process_profiles(spark: SparkSession, lake: Layout, as_of: Column | None = None) -> dict:
    profiles.raw_to_bronze(spark, lake)
    return profiles.bronze_to_silver(spark, lake, as_of).get


def enrich(
    spark: SparkSession,
    lake: Layout,
    as_of: Column | None = None,
    silver: str = "silver",
    gold_db: str = "gold",
) -> int:
    gold.register_silver(spark, lake, silver)
    gold.silver_to_gold(spark, lake, as_of, silver)
    return gold.load_gold_profiles(spark, lake, gold_db)


def run_all(
    spark: SparkSession,
    lake: Layout,
    product: str,
    first: dt.date,
    last: dt.date,
    ages: tuple[int, int] = (20, 30),
    as_of: Column | None = None,
    silver: str = "silver",
    gold_db: str = "gold",
    k: int = 1,
) -> DataFrame:
    """Customers, profiles, sales, enrichment and loads, then the top states."""
    process_customers(spark, lake)
    process_profiles(spark, lake, as_of)
    process_sales(spark, lake)
    enrich(spark, lake, as_of, silver, gold_db)
    gold.load_gold_sales(spark, lake, first, last, gold_db)
    return question.top_states(
        read_table(spark, gold_db, "sales"),
        read_table(spark, gold_db, "user_profiles_enriched"),
        product,
        ages,
        k,
        first=first,
        last=last,
    )


def main(argv: list[str] | None = None) -> None:
    steps = ("customers", "profiles", "sales", "enrich", "load-sales", "all", "food")
    args = argparse.ArgumentParser(description="Run one step, or all steps in order.")
    args.add_argument("step", choices=steps)
    args.add_argument("--root", required=True, help="lake root directory")
    args.add_argument("--as-of", help="day for ages and update stamps; default is now")
    args.add_argument("--first", type=dt.date.fromisoformat, help="first day to load")
    args.add_argument("--last", type=dt.date.fromisoformat, help="last day to load")
    args.add_argument("--product", default="TV")
    args.add_argument("--dump", help="for 'customers': merge only this new dump folder")
    args.add_argument(
        "--then-enrich", action="store_true", help="after the step 'profiles', go on with 'enrich'"
    )
    args.add_argument(
        "--changed", action="store_true", help="for 'all': work off only what was delivered since the last run"
    )
    args.add_argument("--documents", help="food documents, for the step 'food'")
    args.add_argument("--output", help="CSV output directory, for the step 'food'")
    args.add_argument("--derived", help="for 'food': write the derived rows here as Parquet, too")
    args.add_argument("--lines", action="store_true", help="for 'food': documents are JSON Lines")
    given = args.parse_args(argv)
    needed = {
        "load-sales": ("first", "last"), "all": ("first", "last"), "food": ("documents", "output")
    }
    missing = [f"--{n}" for n in needed.get(given.step, ()) if getattr(given, n) is None]
    if missing:
        args.error(f"the step '{given.step}' needs {' and '.join(missing)}")

    spark = build_session(f"lakestrata-{given.step}")
    lake = Layout(given.root)
    as_of = F.lit(given.as_of).cast("date") if given.as_of else None
    if given.step == "customers" and given.dump:
        customers.apply_dump(spark, lake, given.dump)
    elif given.step == "customers":
        print(process_customers(spark, lake))
    elif given.step == "profiles":
        print(process_profiles(spark, lake, as_of))
        if given.then_enrich:
            print(enrich(spark, lake, as_of))
    elif given.step == "sales":
        print(process_sales(spark, lake))
    elif given.step == "enrich":
        print(enrich(spark, lake, as_of))
    elif given.step == "load-sales":
        print(gold.load_gold_sales(spark, lake, given.first, given.last))
    elif given.step == "food":
        print(
            food.export_foods(
                spark, given.documents, given.output, given.derived, lines=given.lines
            )
        )
    elif given.changed:
        print(changed.run_changed(spark, lake, given.first, given.last, as_of))
    else:
        run_all(spark, lake, given.product, given.first, given.last, as_of=as_of).show()


if __name__ == "__main__":
    main()
