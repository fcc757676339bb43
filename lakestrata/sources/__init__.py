"""Readers. All take explicit schemas unless discovery is the point."""

from lakestrata.sources.files import (
    SOURCE_FILE,
    discover_parquet,
    read_csv_text,
    read_json_documents,
    read_json_lines,
    read_parquet,
    source_folder,
    with_source_file,
)
from lakestrata.sources.tables import read_days, read_partition_range, read_table
from lakestrata.sources.widening import TypeConflict, discover_widened

__all__ = [
    "SOURCE_FILE",
    "TypeConflict",
    "discover_parquet",
    "discover_widened",
    "read_csv_text",
    "read_days",
    "read_json_documents",
    "read_json_lines",
    "read_parquet",
    "read_partition_range",
    "read_table",
    "source_folder",
    "with_source_file",
]
