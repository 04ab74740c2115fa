"""Typed sources (parquet fixture tables and CSV files) and sinks."""

from affinity.sources import files, schemas, sinks, tables

__all__ = ["files", "schemas", "sinks", "tables"]
