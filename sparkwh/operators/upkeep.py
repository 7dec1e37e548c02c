"""Which tables need upkeep: counts of deleted rows, statistics, key skew and file ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

# More deleted rows than this, or a larger share than this, call for upkeep.
MIN_DELETED = 1000
MAX_DELETED_SHARE = 0.1


def deleted_counts(tables: dict[str, tuple[DataFrame, Column]]) -> DataFrame:
    """Deleted and total rows per table, one pass each. ``tables`` gives each table its "is deleted" predicate."""
    out = None
    for name, (df, deleted) in tables.items():
        one = df.agg(F.count_if(deleted).alias("deleted_rows"), F.count(F.lit(1)).alias("total_rows")).select(
            F.lit(name).alias("table_name"), "deleted_rows", "total_rows")
        out = one if out is None else out.unionByName(one)
    return out


def maintenance_candidates(tables: dict[str, tuple[DataFrame, Column]], min_deleted: int | None = MIN_DELETED,
                           ratio: float | None = None) -> DataFrame:
    """Tables that need compaction, by a number of deleted rows or, if ``ratio`` is given, by their share."""
    counts = deleted_counts(tables)
    if ratio is None:
        return counts.where(F.col("deleted_rows") > min_deleted)
    share = F.col("deleted_rows").cast("double") / F.col("total_rows")
    return (counts.where((F.col("deleted_rows") > 0) & (F.col("total_rows") > 0))
            .withColumn("deleted_ratio", share).where(F.col("deleted_ratio") > ratio))


def deleted_rows_report(tables: dict[str, tuple[DataFrame, Column]]) -> DataFrame:
    """Tables with deleted rows, most first."""
    return (deleted_counts(tables).where(F.col("deleted_rows") > 0)
            .orderBy(F.col("deleted_rows").desc(), "table_name"))


def analyze_table(spark: SparkSession, table: str, columns: list[str] | None = None, bins: int | None = None) -> None:
    """Collect optimizer statistics; ``bins`` adds equi-height histograms of that many bins."""
    if columns is None:
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")
        return
    held = {}
    if bins is not None:
        for key, value in (("spark.sql.statistics.histogram.enabled", "true"),
                           ("spark.sql.statistics.histogram.numBins", str(bins))):
            held[key] = spark.conf.get(key)
            spark.conf.set(key, value)
    try:
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {', '.join(columns)}")
    finally:
        for key, value in held.items():
            spark.conf.set(key, value)


def column_statistics(spark: SparkSession, table: str, columns: list[str]) -> DataFrame:
    """The statistics the catalog holds, one row per column."""
    out = None
    for column in columns:
        info = spark.sql(f"DESCRIBE EXTENDED {table} {column}")

        def value(name: str) -> Column:
            return F.nullif(F.max(F.when(F.col("info_name") == name, F.col("info_value"))), F.lit("NULL"))

        one = info.agg(F.lit(column).alias("column_name"), value("min").alias("min_value"),
                       value("max").alias("max_value"), value("num_nulls").cast("bigint").alias("null_count"),
                       value("distinct_count").cast("bigint").alias("distinct_count"))
        out = one if out is None else out.unionByName(one)
    return out


def key_skew(df: DataFrame, key: str, n: int, bucket: Column | None = None) -> DataFrame:
    """Rows and distinct keys per hash bucket, and each bucket's rows relative to the mean of the buckets in use."""
    place = F.pmod(F.hash(key), F.lit(n)) if bucket is None else bucket
    # Rows of one key become one row before anything is shuffled by bucket.
    per_key = df.groupBy(F.col(key).alias("_key")).agg(F.max(place).alias("bucket"), F.count(F.lit(1)).alias("_n"))
    buckets = per_key.groupBy("bucket").agg(F.sum("_n").alias("row_count"), F.count("_key").alias("key_count"))
    # At most n rows are left, so the plain window is bounded.
    everything = Window.partitionBy()
    return buckets.withColumn("skew", F.round(F.col("row_count") / F.avg("row_count").over(everything), 4))


def zone_ranges(df: DataFrame, col: str, zone: Column | None = None) -> DataFrame:
    """Smallest and largest value per file, or per ``zone``, by reading the column. ``sources.footers.column_ranges`` gives the
    same per file from the footers of Parquet files."""
    place = F.col("_metadata.file_path") if zone is None else zone
    return df.groupBy(place.alias("file_path")).agg(
        F.count(F.lit(1)).alias("row_count"), F.min(col).alias("min_value"), F.max(col).alias("max_value"),
        F.lit(True).alias("known"))


def zone_overlap(ranges: DataFrame, lo: Column, hi: Column) -> DataFrame:
    """How many files a range filter has to open: few if the sort order is effective."""
    inside = (F.col("max_value") >= lo) & (F.col("min_value") <= hi)
    return ranges.agg(F.count(F.lit(1)).alias("file_count"), F.count_if(~F.col("known") | inside).alias("files_hit"),
                      F.sum("row_count").alias("row_count"))
