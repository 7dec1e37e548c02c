"""Warehouse work on plain Parquet tables, written as Spark DataFrame jobs."""

__version__ = "0.1.0"
