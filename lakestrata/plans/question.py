"""The business question: in which state did an age band buy most of a product?"""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import Column, DataFrame, functions as F

from lakestrata.operators import top_k


def sales_in_window(
    sales: DataFrame,
    product: str,
    *,
    first: dt.date | None = None,
    last: dt.date | None = None,
    month: int | None = None,
    days: tuple[int, int] | None = None,
) -> DataFrame:
    """Sales of one product within a closed date range and/or days of a month of any year."""
    chosen = sales.where(F.col("product_name") == product)
    if first is not None and last is not None:
        chosen = chosen.where(F.col("purchase_date").between(first, last))
    if month is not None:
        chosen = chosen.where(F.month("purchase_date") == month)
    if days is not None:
        chosen = chosen.where(F.dayofmonth("purchase_date").between(*days))
    return chosen


def purchases_by_state(
    sales: DataFrame,
    users: DataFrame,
    ages: tuple[int, int] | None = None,
    years: range | None = None,
) -> DataFrame:
    """Purchases per state; ``ages`` limits the calendar-year difference to the birth date.

    Only the year of a purchase matters for the age. With ``years``, which must cover all
    sales, a client's purchases are counted per year in one row, so that one exchange of the sales
    by client serves the count and the join, and users outside the birth years that can
    match are left out before it. Without, a client has one row per year. Either way a
    client with very many purchases reaches the join as few rows.
    """
    if ages is None:
        per_client = sales.groupBy("client_id").agg(F.count(F.lit(1)).alias("_purchases"))
        joined = per_client.join(users, "client_id")
        return joined.groupBy("state").agg(F.sum("_purchases").alias("purchases"))
    if years is None:
        per_client = sales.groupBy("client_id", F.year("purchase_date").alias("_year")).agg(
            F.count(F.lit(1)).alias("_purchases")
        )
        age = F.col("_year") - F.year("birth_date")
        joined = per_client.join(users, "client_id").where(age.between(*ages))
        return joined.groupBy("state").agg(F.sum("_purchases").alias("purchases"))
    youngest, oldest = ages
    counts = [F.count_if(F.year("purchase_date") == y).alias(f"_in_{y}") for y in years]
    per_client = sales.groupBy("client_id").agg(*counts)
    born = F.year("birth_date")
    able = users.where(born.between(years[0] - oldest, years[-1] - youngest))
    joined = per_client.join(able, "client_id").withColumn("_born", born)
    matching = [
        F.when((F.lit(y) - F.col("_born")).between(*ages), F.col(f"_in_{y}")).otherwise(0) for y in years
    ]
    joined = joined.withColumn("_purchases", functools.reduce(Column.__add__, matching))
    joined = joined.where(F.col("_purchases") > 0)
    return joined.groupBy("state").agg(F.sum("_purchases").alias("purchases"))


def top_states(
    sales: DataFrame,
    users: DataFrame,
    product: str,
    ages: tuple[int, int] | None = None,
    k: int = 1,
    **window,
) -> DataFrame:
    """The ``k`` states with most purchases; equal counts are ordered by state name."""
    first, last = window.get("first"), window.get("last")
    years = range(first.year, last.year + 1) if first and last and first <= last else None
    counts = purchases_by_state(sales_in_window(sales, product, **window), users, ages, years)
    return top_k(counts, "purchases", k, ["state"])
