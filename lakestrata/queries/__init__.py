"""Every operator as a query on the supplied tables, beside the SQL that must agree with it."""

from lakestrata.queries import cleaning, food, gold, grouped, lake, question  # noqa: F401
from lakestrata.queries.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
