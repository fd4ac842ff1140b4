"""Readers for landed data and databases, and the table writer."""

from .readers import RAW_SCHEMAS, load, read_csv, read_json_columns, read_json_lines, read_pages, stack_pages
from .stores import fetch_store_count, fetch_stores, read_stores, scalar, store_count
from .tables import SourceRegistry, list_tables, read_table, write_table

__all__ = [
    "RAW_SCHEMAS", "SourceRegistry", "fetch_store_count", "fetch_stores", "list_tables", "load", "read_csv", "read_json_columns",
    "read_json_lines", "read_pages", "read_stores", "read_table", "scalar", "stack_pages",
    "store_count", "write_table",
]
