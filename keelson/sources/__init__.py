"""Scans (catalog tables, SQL text, files) and the driver-table adapters."""

from keelson.sources.tables import (
    create_csv_table,
    read_csv_declared,
    read_files,
    register_view,
    scan_source_table,
    scan_sql,
    scan_table,
)

__all__ = [
    "create_csv_table",
    "read_csv_declared",
    "read_files",
    "register_view",
    "scan_source_table",
    "scan_sql",
    "scan_table",
]
