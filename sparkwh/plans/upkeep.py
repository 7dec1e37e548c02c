"""Compaction of tables."""

from __future__ import annotations

from dataclasses import replace
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.loads import delete_where
from ..operators.upkeep import MIN_DELETED, analyze_table
from ..sources.files import file_sizes
from .layout import Layout, row_pieces
from .tables import location, obeyed, publish, settle

TARGET_FILE_MB = 256

_REPORT = ("table_name STRING, deleted_before BIGINT, total_before BIGINT, deleted_after BIGINT, total_after BIGINT, "
           "compacted BOOLEAN, error STRING")


def table_bytes(spark: SparkSession, table: str) -> tuple[int, int]:
    """Bytes and number of the files of a table."""
    row = file_sizes(spark, location(spark, table)).agg(F.sum("length"), F.count(F.lit(1))).first()
    return row[0] or 0, row[1]


def compact(spark: SparkSession, table: str, layout: Layout = Layout(), deleted: Column | None = None,
            target_file_mb: int = TARGET_FILE_MB) -> None:
    """Rewrite a table without its deleted rows, in its sort order, as files of about the target size, or of as many rows as a
    task sorts in memory (``layout.ROW_BYTES``) if these make a smaller file. Partitions and buckets stay as they are; inside a
    partition, too, files reach that size."""
    settle(spark, table)
    rows, layout = spark.table(table), obeyed(spark, table, layout)
    kept = rows if deleted is None else delete_where(rows, deleted)
    if layout.dist != "key":
        size, _ = table_bytes(spark, table)
        files = max(ceil(size / (target_file_mb * 1024 * 1024)), row_pieces(kept))
        plain = layout.dist == "auto" and not (layout.sort or layout.interleave or layout.partition_by)
        layout = replace(layout, files=files, dist="even" if plain else layout.dist)
    publish(kept, table, layout)


def selective_compact(spark: SparkSession, tables: dict[str, Column], layouts: dict[str, Layout] | None = None,
                      min_deleted: int | None = MIN_DELETED, ratio: float | None = None) -> DataFrame:
    """Compact and analyze the tables that need it. A table that fails is reported, and the others go on."""
    report = []

    def counts(table: str, deleted: Column) -> tuple[int, int]:
        row = spark.table(table).agg(F.count_if(deleted), F.count(F.lit(1))).first()
        return row[0], row[1]

    for table, deleted in tables.items():
        try:
            if not spark.catalog.tableExists(table):
                raise LookupError(f"no table {table}")
            gone, total = counts(table, deleted)
            needed = gone > min_deleted if ratio is None else gone > 0 and gone / total > ratio
            if needed:
                compact(spark, table, (layouts or {}).get(table, Layout()), deleted)
                analyze_table(spark, table)
            report.append((table, gone, total, *counts(table, deleted), needed, None))
        except Exception as error:
            report.append((table, None, None, None, None, False, str(error).splitlines()[0]))
    return spark.createDataFrame(report, _REPORT)
