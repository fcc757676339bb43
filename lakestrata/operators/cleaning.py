"""Row-local cleaning: no shuffle in any of these."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

REJECT_REASON = "reject_reason"


def trim_strings(df: DataFrame, skip: Sequence[str] = ()) -> DataFrame:
    """Trim spaces around every string column but those in ``skip``."""
    return df.withColumns(
        {
            field.name: F.trim(F.col(field.name))
            for field in df.schema.fields
            if isinstance(field.dataType, T.StringType) and field.name not in skip
        }
    )


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which none of ``columns`` is NULL."""
    return df.dropna(subset=list(columns))


def mark_rejects(df: DataFrame, reasons: Mapping[str, Column]) -> DataFrame:
    """Add the first reason that applies to a row; NULL where the row is fine."""
    return df.withColumn(
        REJECT_REASON,
        F.coalesce(*[F.when(broken, F.lit(reason)) for reason, broken in reasons.items()]),
    )


def accepted_rows(marked: DataFrame) -> DataFrame:
    return marked.where(F.col(REJECT_REASON).isNull()).drop(REJECT_REASON)


def rejected_rows(marked: DataFrame) -> DataFrame:
    return marked.where(F.col(REJECT_REASON).isNotNull())
