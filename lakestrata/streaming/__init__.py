"""Daily increments: each run takes only the files that arrived since the last one."""

from lakestrata.streaming.daily import ingest_new_sales, refine_new_sales

__all__ = ["ingest_new_sales", "refine_new_sales"]
