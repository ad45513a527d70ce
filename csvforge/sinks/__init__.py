"""Sinks: per-table writes."""
from .tables import warehouse_schema, write_table

__all__ = ["warehouse_schema", "write_table"]
