"""Table loading, corruption views and text-log sources."""

from kintsugi.sources.tables import TABLE_NAMES, load_tables, save_table

__all__ = ["TABLE_NAMES", "load_tables", "save_table"]
