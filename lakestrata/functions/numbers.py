"""Numbers out of dirty text, and bands over numbers. Bad input gives NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# What may surround the digits of a price, and the price type.
# The blanks are those that a regular expression calls \s.
PRICE_NOISE = "$, \t\n\x0b\f\r"
PRICE_TYPE = "decimal(12,2)"

# Bounds of the nutrient levels.
MEDIUM_ABOVE = 10
HIGH_ABOVE = 50


def parse_int(value: Column) -> Column:
    """Whole number, NULL for anything else (also for text with decimals)."""
    return value.try_cast("int")


def parse_money(value: Column) -> Column:
    """``' $1,234.50'`` -> 1234.50, rounded half up to cents; NULL when not a price.

    One character-table pass removes all noise, which is cheaper per row than
    a regular expression and gives the same text.
    """
    amount = F.translate(value, PRICE_NOISE, "").try_cast("double")
    return F.round(amount, 2).try_cast(PRICE_TYPE)


def level_bucket(
    value: Column, medium_above: float = MEDIUM_ABOVE, high_above: float = HIGH_ABOVE
) -> Column:
    """High / Medium / Low by two open lower bounds; NULL counts as Low."""
    return (
        F.when(value > high_above, F.lit("High"))
        .when(value > medium_above, F.lit("Medium"))
        .otherwise(F.lit("Low"))
    )
