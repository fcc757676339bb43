"""Reusable Column functions. All are built from JVM-side expressions."""

from lakestrata.functions.dates import (
    FOLDER_DAY,
    LENIENT_DAY,
    STRICT_DAY,
    completed_years,
    parse_day,
    text_year,
    year_boundaries,
)
from lakestrata.functions.numbers import level_bucket, parse_int, parse_money
from lakestrata.functions.text import blank_to_null, normalize_email, split_full_name

__all__ = [
    "FOLDER_DAY",
    "LENIENT_DAY",
    "STRICT_DAY",
    "blank_to_null",
    "completed_years",
    "level_bucket",
    "normalize_email",
    "parse_day",
    "parse_int",
    "parse_money",
    "split_full_name",
    "text_year",
    "year_boundaries",
]
