"""How a table's rows are spread over files, ordered inside them, and encoded."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, DataFrameWriter, functions as F, types as T

from ..functions.interleave import interleave_code, quantile_bounds
from ..functions.scalars import row_hash, value_bytes
from ..session import planned_bytes
from ..sources.zones import note_zones

# Column encodings by their warehouse names, and the Parquet encoding or codec that does the same.
ENCODING_NAMES = {
    "RAW": "plain",
    "RUNLENGTH": "dict",
    "BYTEDICT": "dict",
    "DELTA": "delta",
    "TEXT255": "dict",
    "LZO": "plain",
    "ZSTD": "plain",
}
CODECS = ("none", "snappy", "gzip", "lz4", "zstd")


@dataclass(frozen=True)
class Layout:
    """``dist``: ``auto`` (as computed), ``even`` (round robin over ``files``), ``all`` (one file, for tables that are copied
    to every task) or ``key`` (``buckets`` hash buckets of ``key``). Where ``files`` or ``buckets`` are not given, they follow
    from the size of the data: one per ``FILE_BYTES``; files dealt over tasks also hold no more than about ``ROW_BYTES`` of rows.
    Then an order inside: ``sort`` columns, or ``interleave`` columns with ``bits`` bits each. ``encodings`` maps columns to
    ``dict``, ``delta`` or ``plain``. ``bloom`` names key columns by whose values
    row groups are left out where neither order nor a dictionary tells: each gets a Bloom filter of up to a megabyte."""

    dist: str = "auto"
    key: str | None = None
    buckets: int | None = None
    files: int | None = None
    sort: tuple[str, ...] = ()
    interleave: tuple[str, ...] = ()
    bits: int = 4
    partition_by: tuple[str, ...] = ()
    encodings: dict[str, str] = field(default_factory=dict)
    codec: str = "zstd"
    bloom: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if self.dist not in ("auto", "even", "all", "key"):
            raise ValueError(f"unknown distribution {self.dist}")
        if (self.dist == "key") != (self.key is not None):
            raise ValueError("a key goes with, and only with, dist='key'")
        if self.buckets is not None and self.buckets < 1:
            raise ValueError("at least one bucket")
        if self.dist == "key" and (self.interleave or self.partition_by):
            raise ValueError("a bucketed table takes a sort order, not interleaving or partitions")
        if self.sort and self.interleave:
            raise ValueError("either sort or interleave")
        if self.codec not in CODECS:
            raise ValueError(f"unknown codec {self.codec}")
        unknown = set(self.encodings.values()) - {"dict", "delta", "plain"}
        if unknown:
            raise ValueError(f"unknown encodings {sorted(unknown)}")


def _hashable(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.StructType):
        return all(_hashable(f.dataType) for f in data_type.fields)
    if isinstance(data_type, T.ArrayType):
        return _hashable(data_type.elementType)
    return not isinstance(data_type, (T.MapType, T.VariantType))


def _tie_split(df: DataFrame) -> list:
    """A last range column that splits rows with equal sort values over several partitions."""
    return [row_hash([f.name for f in df.schema.fields if _hashable(f.dataType)])]


def _by_range(df: DataFrame, columns: list, files: int | None) -> DataFrame:
    order = [F.col(c) for c in columns] + _tie_split(df)
    spread = df.repartitionByRange(files, *order) if files else df.repartitionByRange(*order)
    return spread.sortWithinPartitions(*columns)


#: Bytes that one file, bucket or range of a layout should hold.
FILE_BYTES = 256 * 1024 * 1024
#: Bytes of rows in memory that one task should deal into a file, so that it can sort them there.
ROW_BYTES = 256 * 1024 * 1024
#: Most that a table laid out as one file may measure.
ALL_BYTES = 256 * 1024 * 1024


def pieces_of(df: DataFrame, piece_bytes: int = FILE_BYTES) -> int:
    """How many files or buckets hold ``df`` at ``piece_bytes`` each; the session's shuffle partitions if its size is unknown."""
    size = planned_bytes(df)
    if size is None:
        return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, -(-size // piece_bytes))


def row_bytes(df: DataFrame) -> int:
    """Bytes of the rows of ``df`` in memory, in one pass that reads what has no fixed length."""
    values = [value_bytes(F.col("`" + f.name.replace("`", "``") + "`"), f.dataType) for f in df.schema.fields]
    return df.agg(F.sum(sum(values, F.lit(8 * (1 + len(values))).cast("bigint")))).first()[0] or 0


def row_pieces(df: DataFrame) -> int:
    """How many tasks can each sort their share of ``df`` in memory. What rows take there does not follow from the size of the
    files they come from, which may be compressed to any degree."""
    return max(1, -(-row_bytes(df) // ROW_BYTES))


def files_of(df: DataFrame) -> int:
    """How many files to deal ``df`` over, each by one task."""
    return max(pieces_of(df), row_pieces(df))


def _clustered(df: DataFrame, layout: Layout) -> tuple[DataFrame, list]:
    """``df`` with a clustering code if the layout has one, and the columns of its order inside files."""
    if not layout.interleave:
        return df, list(layout.sort)
    bounds = quantile_bounds(df, list(layout.interleave), layout.bits)
    code = interleave_code([(F.col(c), b) for c, b in zip(layout.interleave, bounds)], layout.bits)
    return df.withColumn("_code", code), ["_code"]


def arrange(df: DataFrame, layout: Layout) -> DataFrame:
    """``df`` partitioned and sorted for writing.

    Key and partition layouts go through a REBALANCE, which hashes by key and lets Spark split what is too large for
    one task into several files, and merge what is too small.
    """
    if layout.dist == "key":
        return df.hint("rebalance", layout.buckets or pieces_of(df), layout.key)
    if layout.dist == "all":
        size = planned_bytes(df)
        if size is not None and size > ALL_BYTES:
            raise ValueError(f"a table of {size} bytes is too large to be laid out as one file")
        return df.coalesce(1)
    columns = df.columns
    marked, order = _clustered(df, layout)
    if layout.partition_by:
        if layout.files or order:  # ranges cut large partitions into files, and keep each file's share of the order
            return _by_range(marked, [*layout.partition_by, *order], layout.files or files_of(df)).select(*columns)
        return df.hint("rebalance", *layout.partition_by).sortWithinPartitions(*layout.partition_by)
    if order:
        return _by_range(marked, order, layout.files or files_of(df)).select(*columns)
    if layout.dist == "even":
        return df.repartition(layout.files or files_of(df))
    return df


def writer_options(layout: Layout) -> dict[str, str]:
    """Parquet writer options. Delta needs the version-2 writer, which then also uses it for ``plain`` integers."""
    options = {"compression": layout.codec}
    if layout.encodings:
        options["parquet.enable.dictionary"] = "false"
        if "delta" in layout.encodings.values():
            options["parquet.writer.version"] = "v2"
        for column, encoding in layout.encodings.items():
            options[f"parquet.enable.dictionary#{column}"] = "true" if encoding == "dict" else "false"
    for column in layout.bloom:
        options[f"parquet.bloom.filter.enabled#{column}"] = "true"
    if layout.bloom:  # as large as the values of a row group need
        options["parquet.bloom.filter.adaptive.enabled"] = "true"
    return options


def writer(df: DataFrame, layout: Layout) -> DataFrameWriter:
    out = arrange(df, layout).write.format("parquet").options(**writer_options(layout))
    if layout.partition_by:
        out = out.partitionBy(*layout.partition_by)
    if layout.dist == "key":
        out = out.bucketBy(layout.buckets or pieces_of(df), layout.key).sortBy(*(layout.sort or (layout.key,)))
    return out


def write_files(df: DataFrame, path: str, layout: Layout = Layout()) -> None:
    """Write files in a layout, and for sorted or clustered ones the ranges of those columns per file, by which
    ``sources.zones.scan_zones`` leaves files out. Buckets exist only for catalog tables: see ``tables.save_table``."""
    if layout.dist == "key":
        raise ValueError("a bucketed layout needs a table")
    writer(df, layout).save(path)
    if layout.sort or layout.interleave:
        note_zones(df.sparkSession, path, list(layout.sort or layout.interleave))
