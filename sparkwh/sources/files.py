"""Scans of files and external tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# URL schemes read as files.
FILE_SCHEMES = ("s3", "s3a", "hdfs", "abfss", "gs", "file")


def read_delimited(spark: SparkSession, path: str, schema: str | T.StructType, sep: str = ",") -> DataFrame:
    """Delimited text without a header; columns are typed by the declared schema, never inferred."""
    return spark.read.schema(schema).option("sep", sep).option("header", False).csv(path)


def read_parquet(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_partitioned(spark: SparkSession, path: str, schema: str | T.StructType, fmt: str = "csv",
                     **options: str) -> DataFrame:
    """Directory-partitioned files; the partition columns are part of ``schema`` and so keep their declared types."""
    return spark.read.format(fmt).schema(schema).options(**options).load(path)


def jdbc_options(source: str, dbtable: str, *, partition_column: str | None = None, lower: object = None,
                 upper: object = None, partitions: int | None = None, fetch_size: int = 10_000,
                 **extra: str) -> dict[str, str]:
    """Options of a JDBC read. A partitioned read needs all four of column, bounds and partition count."""
    options = {"url": source, "dbtable": dbtable, "fetchsize": str(fetch_size), **extra}
    split = (partition_column, lower, upper, partitions)
    if any(v is not None for v in split):
        if any(v is None for v in split):
            raise ValueError("a partitioned JDBC read needs partition_column, lower, upper and partitions")
        options.update(partitionColumn=partition_column, lowerBound=str(lower), upperBound=str(upper),
                       numPartitions=str(partitions))
    return options


def extract(spark: SparkSession, source: str | None, *, fmt: str = "parquet",
            schema: str | T.StructType | None = None, **options) -> DataFrame:
    """Read from wherever ``source`` points: a file URL or path, or ``jdbc:``."""
    if not source:
        raise ValueError("extract needs a source")
    if source.startswith("jdbc:"):
        return spark.read.format("jdbc").options(**jdbc_options(source, **options)).load()
    scheme, found, _ = source.partition(":/")
    if source.startswith("/") or (found and scheme in FILE_SCHEMES):
        reader = spark.read.format(fmt).options(**options)
        return (reader.schema(schema) if schema is not None else reader).load(source)
    raise ValueError(f"Unsupported source type: {source}")


def create_database(spark: SparkSession, name: str, location: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{location}'")


def create_external_table(spark: SparkSession, table: str, schema: str, fmt: str, location: str,
                          partition_by: tuple[str, ...] = (), **options: str) -> None:
    """Declare a table over files that stay where they are."""
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    opts = ", ".join(f"'{k}' '{v}'" for k, v in options.items())
    spark.sql(f"CREATE TABLE {table} ({schema}) USING {fmt}"
              + (f" OPTIONS ({opts})" if opts else "") + parts + f" LOCATION '{location}'")


def register_partition(spark: SparkSession, table: str, spec: dict[str, str], location: str | None = None) -> None:
    """Make one more directory of a partitioned table visible."""
    values = ", ".join(f"{k}='{v}'" for k, v in spec.items())
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({values}){where}")


def recover_partitions(spark: SparkSession, table: str) -> None:
    """Make every partition directory below the table's location visible."""
    spark.sql(f"MSCK REPAIR TABLE {table}")


# Folders of the indexes that lie beside a table's files (``zones``, ``grams``).
ZONES, GRAMS = "_zones", "_grams"


def plain_path(path: Column) -> Column:
    """A path without its scheme, which listings, footers and scans may write differently."""
    return F.regexp_replace(path, "^[a-zA-Z0-9]+:/*", "/")


def file_sizes(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """``path, length`` of the data files below ``path``; a listing only, no content is read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True)
            .load(path).select("path", "length").where(~F.col("path").rlike(f"/({ZONES}|{GRAMS})/[^/]*$")))
