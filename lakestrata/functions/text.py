"""Text cleaning."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def blank_to_null(value: Column) -> Column:
    """Trim spaces; an empty rest is a missing value, so that fills can see it."""
    return F.nullif(F.trim(value), F.lit(""))


def normalize_email(value: Column) -> Column:
    """Join key form of an address: trimmed, lower case, NULL when blank."""
    return blank_to_null(F.lower(value))


def split_full_name(value: Column) -> tuple[Column, Column]:
    """``(first name, rest)``, split once at the first space."""
    parts = F.split(blank_to_null(value), " ", 2)
    return F.try_element_at(parts, F.lit(1)), blank_to_null(F.try_element_at(parts, F.lit(2)))
