"""Dates out of text, and the two meanings of "age"."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Accepted day formats. Folders may be named with or without zeros.
LENIENT_DAY = "yyyy-MM-d"
STRICT_DAY = "yyyy-MM-dd"
FOLDER_DAY = "yyyy-M-d"


def parse_day(value: Column, pattern: str = LENIENT_DAY) -> Column:
    """Date in ``pattern``; NULL when the text does not fit."""
    return F.try_to_date(value, pattern)


def text_year(value: Column) -> Column:
    """Year of an ISO date held as text; NULL when it is not a date."""
    return F.year(value.try_cast("date"))


def year_boundaries(start: Column, end: Column) -> Column:
    """How many New Year's days lie between two dates."""
    return F.year(end) - F.year(start)


def completed_years(birth: Column, as_of: Column) -> Column:
    """Age in the everyday sense: birthdays passed by ``as_of``."""
    return F.floor(F.months_between(as_of, birth) / 12).cast("int")
