"""Readers and writers of stages, preference files, reports and uploads."""

from stockloom.sources.readers import explode_lines, load_csv_explicit, load_csv_typed, scan_limit
from stockloom.sources.writers import (
    append_history,
    append_tagged,
    export_chunked,
    export_delimited,
    rename_display,
    replace_table,
    write_stage,
)

__all__ = [
    "append_history", "append_tagged", "explode_lines", "export_chunked",
    "export_delimited", "load_csv_explicit", "load_csv_typed",
    "rename_display", "replace_table", "scan_limit", "write_stage",
]
