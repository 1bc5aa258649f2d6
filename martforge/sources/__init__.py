"""Readers, writers, source catalogs and the adapters of the driver tables."""

from martforge.sources.io import DRIVER_TABLES, read_jdbc, read_table, table_path

__all__ = ["DRIVER_TABLES", "read_jdbc", "read_table", "table_path"]
