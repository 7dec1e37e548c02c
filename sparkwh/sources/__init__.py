"""Scans: files, external tables, synthetic rows, Spark event logs, Parquet footers."""
