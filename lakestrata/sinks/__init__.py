"""Writers."""

from lakestrata.sinks.files import (
    observed,
    write_csv,
    write_parquet,
    write_partitioned,
)

__all__ = ["observed", "write_csv", "write_parquet", "write_partitioned"]
