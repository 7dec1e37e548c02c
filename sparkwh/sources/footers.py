"""What the Parquet files of a table really use: encodings, codec and sizes per column."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F

from .files import file_sizes

_CHUNKS = ("path STRING, row_group INT, column_name STRING, codec STRING, encodings ARRAY<STRING>, "
           "value_count BIGINT, compressed_bytes BIGINT, uncompressed_bytes BIGINT")


# How each URL scheme is called where footers are read.
_READER_SCHEMES = {"file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "gs": "gs"}


def _footer_paths(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """The files below ``path``, named as the footer reader knows them; an error here, not in a task, if it cannot read them."""
    scheme = path.partition(":/")[0] if ":/" in path else "file"
    if scheme not in _READER_SCHEMES:
        raise ValueError(f"footers cannot be read from {scheme}:")
    found = file_sizes(spark, path, glob).select("path")
    if _READER_SCHEMES[scheme] == scheme:
        return found
    return found.select(F.regexp_replace("path", f"^{scheme}:", f"{_READER_SCHEMES[scheme]}:").alias("path"))


def _footer_reader(names: list[str]):
    """The task's function, built here so that it travels to executors by value: they need pyarrow, not this package."""

    def read(batches: Iterator) -> Iterator:
        import pandas as pd
        import pyarrow.fs
        import pyarrow.parquet as pq

        for batch in batches:
            for path in batch["path"]:
                fs, inner = pyarrow.fs.FileSystem.from_uri(path)
                with fs.open_input_file(inner) as handle:
                    footer = pq.read_metadata(handle)
                rows = []
                for group in range(footer.num_row_groups):
                    meta = footer.row_group(group)
                    for place in range(meta.num_columns):
                        chunk = meta.column(place)
                        rows.append((path, group, chunk.path_in_schema, chunk.compression, list(chunk.encodings),
                                     chunk.num_values, chunk.total_compressed_size, chunk.total_uncompressed_size))
                yield pd.DataFrame(rows, columns=names)
    return read


def _range_reader(columns: list[str]):
    """As above, for the value ranges of some columns; a row group without statistics leaves the file's range unknown."""

    def read(batches: Iterator) -> Iterator:
        import pandas as pd
        import pyarrow.fs
        import pyarrow.parquet as pq

        for batch in batches:
            rows = []
            for path in batch["path"]:
                fs, inner = pyarrow.fs.FileSystem.from_uri(path)
                with fs.open_input_file(inner) as handle:
                    footer = pq.read_metadata(handle)
                for column in columns:
                    ranges, known = [], True
                    for group in range(footer.num_row_groups):
                        meta = footer.row_group(group)
                        found = [meta.column(i).statistics for i in range(meta.num_columns)
                                 if meta.column(i).path_in_schema == column]
                        if found and found[0] is not None and found[0].has_min_max:
                            ranges.append((found[0].min, found[0].max))
                        else:
                            empty = found and found[0] is not None and found[0].null_count == meta.num_rows
                            known = known and bool(empty)
                    lo = str(min(r[0] for r in ranges)) if known and ranges else None
                    hi = str(max(r[1] for r in ranges)) if known and ranges else None
                    rows.append((path, column, footer.num_rows, lo, hi, known))
            yield pd.DataFrame(rows, columns=["file_path", "column_name", "row_count", "min_value", "max_value", "known"])
    return read


def many_ranges(paths: DataFrame, columns: list[str]) -> DataFrame:
    """``file_path, column_name, row_count, min_value, max_value, known`` per file of ``paths`` and column, the values as text."""
    return paths.mapInPandas(_range_reader(columns), "file_path STRING, column_name STRING, row_count BIGINT, "
                                                     "min_value STRING, max_value STRING, known BOOLEAN")


def column_ranges(spark: SparkSession, path: str, column: str, data_type: str, glob: str = "*.parquet") -> DataFrame:
    """``file_path, row_count, min_value, max_value, known`` per file, from the footers: no column data is read.

    ``known`` is false where a file keeps no statistics for the column, so that no filter can skip it.
    """
    ranges = many_ranges(_footer_paths(spark, path, glob), [column]).drop("column_name")
    return ranges.withColumns({c: F.col(c).cast(data_type) for c in ("min_value", "max_value")})


def column_chunks(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """One row per column chunk. Each executor opens the footers of its share of the files."""
    return _footer_paths(spark, path, glob).mapInPandas(
        _footer_reader([field.split(" ")[0] for field in _CHUNKS.split(", ")]), _CHUNKS)


def compression_report(spark: SparkSession, tables: dict[str, tuple[str, str]], schema_name: str = "public") -> DataFrame:
    """Codec, encodings and sizes per table column. ``tables`` maps a table name to (folder, file-name glob)."""
    report = None
    for name, (path, glob) in tables.items():
        one = column_chunks(spark, path, glob).withColumn("table_name", F.lit(name))
        report = one if report is None else report.unionByName(one)
    saved = 1 - F.col("compressed_bytes") / F.nullif(F.col("uncompressed_bytes"), F.lit(0))
    return (report.groupBy("table_name", "column_name").agg(
                F.array_join(F.sort_array(F.collect_set("codec")), ",").alias("codec"),
                F.array_join(F.sort_array(F.array_distinct(F.flatten(F.collect_set("encodings")))), ",")
                .alias("encodings"),
                F.count_if(F.col("row_group") == 0).alias("files"),
                F.sum("value_count").alias("value_count"),
                F.sum("compressed_bytes").alias("compressed_bytes"),
                F.sum("uncompressed_bytes").alias("uncompressed_bytes"))
            .withColumn("saved", F.round(saved, 4)).withColumn("schema_name", F.lit(schema_name))
            .orderBy("schema_name", "table_name", "column_name"))
