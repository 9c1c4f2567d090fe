"""Writers: partitioned Parquet, staged publish, raw archives."""

from obsflow.sinks.archive import write_context_archive, write_page_snapshot
from obsflow.sinks.parquet import append, preview, read_back, verify_count, write_partitioned

__all__ = [
    "append",
    "preview",
    "read_back",
    "verify_count",
    "write_context_archive",
    "write_page_snapshot",
    "write_partitioned",
]
