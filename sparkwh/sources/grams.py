"""A stored index of the three-character runs in a text column per file, by which a search with LIKE opens only files that
can hold its pattern.

Every run is hashed to one of ``PLACES`` bits; a file has the bits of all its runs, in pieces as Spark's bitmap functions make
them. A pattern's fixed parts need certain bits; a file that lacks one has no row that fits. The index lies beside the
files, in a folder that Spark does not take for data; files that came without it are not in it, and are opened.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..session import exists
from .files import GRAMS, file_sizes, plain_path

# Fixed value: bits of one bitmap of Spark's.
_PIECE = 32_768
# Bits per file, 32 kB. A file whose texts have some ten thousand different runs is opened by mistake for about one run in 25.
PLACES = 8 * _PIECE
_RUN = 3
_SCHEMA = "file_path STRING, column_name STRING, piece BIGINT, bits BINARY"


def _places(text: Column) -> Column:
    """The places of all runs of a text; none for NULL and for texts of fewer characters."""
    letters = F.split(text, "")
    runs = letters
    for k in range(1, _RUN):  # pairs of neighbours end in NULL where a text ends
        runs = F.zip_with(runs, F.slice(letters, k + 1, F.length(text)), lambda a, b: F.concat(a, b))
    return F.transform(F.array_distinct(F.filter(runs, lambda r: r.isNotNull())), lambda r: F.pmod(F.xxhash64(r), F.lit(PLACES)))


def fixed_parts(pattern: str) -> list[str]:
    """What a LIKE pattern asks for letter by letter, between its wildcards; a backslash takes the next sign as it is."""
    parts, now, taken = [], "", False
    for sign in pattern:
        if not taken and sign == "\\":
            taken = True
        elif not taken and sign in "%_":
            parts.append(now)
            now = ""
        else:
            now, taken = now + sign, False
    return [p for p in [*parts, now] if len(p) >= _RUN]


def stored_grams(spark: SparkSession, path: str) -> DataFrame:
    place = f"{path}/{GRAMS}"
    return spark.read.schema(_SCHEMA).parquet(place) if exists(spark, place) else spark.createDataFrame([], _SCHEMA)


def note_grams(spark: SparkSession, path: str, column: str) -> None:
    """Add the files that are not in the index of ``column`` yet, whose texts are read once. Only file names reach the driver.
    The column must compare byte by byte: under another collation a search may fit texts with other runs."""
    schema = spark.read.parquet(path).schema
    if schema[column].dataType != T.StringType():
        raise ValueError(f"{column} is not a plain text column")
    known = stored_grams(spark, path).where(F.col("column_name") == column).select("file_path").distinct()
    found = file_sizes(spark, path).select("path", plain_path(F.col("path")).alias("file_path"))
    new = [r["path"] for r in found.join(known, "file_path", "left_anti").select("path").collect()]
    if not new:
        return
    texts = spark.read.schema(schema).option("basePath", path).parquet(*new).select(
        plain_path(F.col("_metadata.file_path")).alias("file_path"), F.col(column).alias("text"))
    # A file has a place once at most before anything is packed; -1 stands for the file itself, if it has no runs.
    places = texts.select("file_path", F.explode(F.concat(F.array(F.lit(-1).cast("bigint")), F.coalesce(_places(F.col("text")), F.array().cast("array<bigint>"))))
                          .alias("place")).distinct()
    piece = F.when(F.col("place") < 0, F.col("place")).otherwise(F.floor(F.col("place") / _PIECE)).alias("piece")
    (places.groupBy("file_path", F.lit(column).alias("column_name"), piece)
     .agg(F.bitmap_construct_agg(F.pmod("place", F.lit(_PIECE))).alias("bits")).write.mode("append").parquet(f"{path}/{GRAMS}"))


def files_that_may_hold(spark: SparkSession, path: str, column: str, pattern: str) -> list[str]:
    """The files below ``path`` that may have a row whose ``column`` is LIKE ``pattern``: all of them if the pattern has no fixed
    part of three characters. Only names of these files reach the driver."""
    listed = file_sizes(spark, path).select("path", plain_path(F.col("path")).alias("file_path"))
    parts = fixed_parts(pattern)
    if parts:
        asked = (spark.createDataFrame([(p,) for p in parts], "text STRING").select(F.explode(_places(F.col("text"))).alias("place")).distinct()
                 .select(F.floor(F.col("place") / _PIECE).alias("piece"), F.pmod("place", F.lit(_PIECE)).alias("bit")))
        total = asked.count()
        index = stored_grams(spark, path).where(F.col("column_name") == column)
        byte = F.conv(F.hex(F.expr("substring(bits, cast(bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
        is_set = byte.bitwiseAND(F.expr("shiftleft(1, cast(bit % 8 as int))")) != 0
        # As many rows as the pattern has runs, at most.
        held = (index.join(F.broadcast(asked), "piece").where(is_set).groupBy("file_path").agg(F.count(F.lit(1)).alias("n"))
                .where(F.col("n") == total).select("file_path"))
        lacking = index.select("file_path").distinct().join(held, "file_path", "left_anti")
        listed = listed.join(lacking, "file_path", "left_anti")
    return sorted(r["path"] for r in listed.select("path").collect())


def search_text(spark: SparkSession, path: str, column: str, pattern: str) -> DataFrame:
    """The rows below ``path`` whose ``column`` is LIKE ``pattern``; only files that may hold one are opened."""
    schema, chosen = spark.read.parquet(path).schema, files_that_may_hold(spark, path, column, pattern)
    if not chosen:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*chosen).where(F.col(column).like(pattern))
