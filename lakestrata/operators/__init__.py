"""Operators: DataFrame in, DataFrame out."""

from lakestrata.operators.cleaning import (
    REJECT_REASON,
    accepted_rows,
    mark_rejects,
    rejected_rows,
    require_columns,
    trim_strings,
)
from lakestrata.operators.dedupe import drop_duplicate_keys, keep_latest
from lakestrata.operators.enrichment import left_fill, upsert
from lakestrata.operators.grouped import (
    average_by,
    count_by,
    distinct_count_by,
    median_by,
    rows_by,
    sum_by,
    top_k,
)
from lakestrata.operators.nested import explode_records
from lakestrata.operators.quality import duplicate_keys, quality_counts, too_wide
from lakestrata.operators.scaling import group_bounds, minmax_normalize, scale_between
from lakestrata.operators.sketches import estimates, merge_sketches, sketch_by

__all__ = [
    "REJECT_REASON",
    "accepted_rows",
    "average_by",
    "count_by",
    "distinct_count_by",
    "drop_duplicate_keys",
    "duplicate_keys",
    "estimates",
    "explode_records",
    "group_bounds",
    "keep_latest",
    "left_fill",
    "mark_rejects",
    "median_by",
    "merge_sketches",
    "minmax_normalize",
    "quality_counts",
    "rejected_rows",
    "require_columns",
    "rows_by",
    "scale_between",
    "sketch_by",
    "sum_by",
    "too_wide",
    "top_k",
    "trim_strings",
    "upsert",
]
