"""A stored index of value ranges per file, by which a scan opens only files that can hold what it asks for.

The index is a small Parquet table beside the files, in a folder that Spark does not take for data. It is written from the
footers when sorted or clustered files are written; files that came without it are not in it, and are opened.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import exists
from .files import ZONES, file_sizes, plain_path
from .footers import many_ranges

_SCHEMA = "file_path STRING, column_name STRING, row_count BIGINT, min_value STRING, max_value STRING, known BOOLEAN"


def stored_zones(spark: SparkSession, path: str) -> DataFrame:
    """The index of the files below ``path``: a row per file and column; none if nothing has been noted."""
    place = f"{path}/{ZONES}"
    return spark.read.schema(_SCHEMA).parquet(place) if exists(spark, place) else spark.createDataFrame([], _SCHEMA)


def note_zones(spark: SparkSession, path: str, columns: list[str]) -> None:
    """Add the files that are not in the index yet. Their footers are read, each once for all columns."""
    known = stored_zones(spark, path).select("file_path").distinct()
    found = file_sizes(spark, path).select("path")
    new = found.withColumn("file_path", plain_path(F.col("path"))).join(known, "file_path", "left_anti").select("path")
    noted = many_ranges(new, columns).withColumn("file_path", plain_path(F.col("file_path")))
    noted.coalesce(1).write.mode("append").parquet(f"{path}/{ZONES}")


def files_meeting(spark: SparkSession, path: str, ranges: dict[str, tuple[object, object]]) -> list[str]:
    """The files below ``path`` that may hold a row with every column of ``ranges`` in its closed range; None leaves a side
    open. Only names of these files reach the driver."""
    types = {f.name: f.dataType for f in spark.read.parquet(path).schema.fields}

    def misses(column: str, low: object, high: object) -> Column:
        least, most = (F.col(c).cast(types[column]) for c in ("min_value", "max_value"))
        sides = [most < low] * (low is not None) + [least > high] * (high is not None)
        return (F.col("column_name") == column) & F.col("known") & reduce(lambda a, b: a | b, sides, F.col("min_value").isNull())
    out = reduce(lambda a, b: a | b, [misses(c, *bounds) for c, bounds in ranges.items()], F.lit(False))
    excluded = stored_zones(spark, path).where(out).select("file_path").distinct()
    listed = file_sizes(spark, path).select("path", plain_path(F.col("path")).alias("file_path"))
    return sorted(r["path"] for r in listed.join(excluded, "file_path", "left_anti").select("path").collect())


def scan_zones(spark: SparkSession, path: str, ranges: dict[str, tuple[object, object]]) -> DataFrame:
    """The rows below ``path`` with every column of ``ranges`` in its closed range. Only files whose zones meet all ranges are
    opened; inside them the usual filters reach the row groups."""
    schema, chosen = spark.read.parquet(path).schema, files_meeting(spark, path, ranges)
    if not chosen:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", path).parquet(*chosen)
    for column, (low, high) in ranges.items():
        rows = rows.where(F.col(column) >= low) if low is not None else rows
        rows = rows.where(F.col(column) <= high) if high is not None else rows
    return rows
