import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakestrata import functions as L

D = dt.date


def evaluate(spark, expression, *values, schema="a STRING"):
    return spark.createDataFrame([values], schema).select(expression).first()[0]


@pytest.mark.parametrize(
    "text, price",
    [
        ("$1,500.50", Decimal("1500.50")),
        (" 1 299.99\t", Decimal("1299.99")),
        ("1.005", Decimal("1.01")),
        ("-3.2", Decimal("-3.20")),
        ("$", None),
        ("", None),
        (None, None),
        ("700USD", None),
        ("€5", None),
        ("NaN", None),
        ("Infinity", None),
        ("9999999999.99", Decimal("9999999999.99")),
        ("99999999999", None),
    ],
)
def test_parse_money(spark, text, price):
    assert evaluate(spark, L.parse_money(F.col("a")), text) == price


def test_parse_money_on_many_written_forms(spark):
    rng = random.Random(11)
    cases = []
    for _ in range(2000):
        cents = rng.randrange(10 ** rng.randrange(1, 13))
        text = f"{cents // 100:,}.{cents % 100:02d}"
        text = "".join(c + rng.choice(["", "", "", " ", "\t"]) for c in rng.choice(["$", ""]) + text)
        cases.append((text, Decimal(cents) / 100))
    df = spark.createDataFrame(cases, "a STRING, wanted DECIMAL(12,2)")
    assert df.where(~L.parse_money(F.col("a")).eqNullSafe(F.col("wanted"))).count() == 0


def test_price_noise_is_what_a_blank_pattern_matches(spark):
    every = "".join(chr(c) for c in range(1, 256))
    by_pattern = F.regexp_replace(F.regexp_replace("a", r"[\$,]", ""), r"\s+", "")
    by_table = F.translate("a", L.numbers.PRICE_NOISE, "")
    assert evaluate(spark, by_pattern == by_table, every)


@pytest.mark.parametrize(
    "text, number", [("12", 12), (" 7 ", 7), ("12.7", None), ("abc", None), ("", None), (None, None)]
)
def test_parse_int(spark, text, number):
    assert evaluate(spark, L.parse_int(F.col("a")), text) == number


@pytest.mark.parametrize(
    "text, day",
    [
        ("2022-09-1", D(2022, 9, 1)),
        ("2022-09-01", D(2022, 9, 1)),
        ("2022-9-01", None),
        ("2022/09/01", None),
        ("", None),
        (None, None),
        ("2022-02-30", None),
    ],
)
def test_parse_lenient_day(spark, text, day):
    assert evaluate(spark, L.parse_day(F.col("a")), text) == day


@pytest.mark.parametrize("text, day", [("1995-03-10", D(1995, 3, 10)), ("1995-03-1", None)])
def test_parse_strict_day(spark, text, day):
    assert evaluate(spark, L.parse_day(F.col("a"), L.STRICT_DAY), text) == day


@pytest.mark.parametrize("text, year", [("2022-01-01", 2022), ("bad", None), (None, None)])
def test_text_year(spark, text, year):
    assert evaluate(spark, L.text_year(F.col("a")), text) == year


def test_two_ages(spark):
    birth, bought = D(2002, 12, 31), D(2022, 9, 1)
    a, b = F.col("a"), F.col("b")
    schema = "a DATE, b DATE"
    assert evaluate(spark, L.year_boundaries(a, b), birth, bought, schema=schema) == 20
    assert evaluate(spark, L.completed_years(a, b), birth, bought, schema=schema) == 19
    assert evaluate(spark, L.completed_years(a, b), D(2000, 9, 1), bought, schema=schema) == 22
    assert evaluate(spark, L.completed_years(a, b), None, bought, schema=schema) is None


@pytest.mark.parametrize(
    "value, level",
    [(50.1, "High"), (50.0, "Medium"), (10.5, "Medium"), (10.0, "Low"), (0.0, "Low"), (None, "Low")],
)
def test_level_bucket(spark, value, level):
    assert evaluate(spark, L.level_bucket(F.col("a")), value, schema="a DOUBLE") == level


@pytest.mark.parametrize(
    "name, parts",
    [
        ("Anna Lee", ("Anna", "Lee")),
        (" Nine Van Dyke ", ("Nine", "Van Dyke")),
        ("Cher", ("Cher", None)),
        ("Bob  Moore", ("Bob", "Moore")),
        ("  ", (None, None)),
        (None, (None, None)),
    ],
)
def test_split_full_name(spark, name, parts):
    first, last = L.split_full_name(F.col("a"))
    assert tuple(evaluate(spark, F.struct(first, last), name)) == parts


@pytest.mark.parametrize(
    "text, clean", [(" A@B.Com ", "a@b.com"), ("   ", None), ("", None), (None, None)]
)
def test_normalize_email(spark, text, clean):
    assert evaluate(spark, L.normalize_email(F.col("a")), text) == clean


def test_blank_to_null_trims_spaces_only(spark):
    assert evaluate(spark, L.blank_to_null(F.col("a")), " \tx ") == "\tx"
    assert evaluate(spark, L.blank_to_null(F.col("a")), "  ") is None
