"""Tables in the session catalog: create, append, and replace as a whole or by partition.

Parquet tables have no row-level UPDATE, DELETE or MERGE. A change is computed as a DataFrame, written to a new folder,
and then made current by changing locations in the catalog: of a whole table in one step, of partitions one after another.
Which partitions go where is written down first, so that a swap that was broken off is finished by the next call that
changes the table (or by ``settle``); at no time is a partition absent. Every write follows the partitions and buckets that
the catalog has for the table.

Segmented tables are tables without partitions of their own whose files can be replaced one by one: each file, or group of
files, is a partition of the column ``_segment``. An upsert or delete by key rewrites only the segments that hold its keys.
One writer at a time may change a table.
"""

from __future__ import annotations

import time
import uuid
from contextlib import contextmanager
from dataclasses import replace
from functools import reduce
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.loads import delete_where, upsert
from ..session import exists, make_folder, new_name, new_path, remove_folder, subfolders
from ..sources.files import file_sizes
from .layout import Layout, arrange, files_of, pieces_of, writer

#: The column that names the segment of a row, in segmented tables only.
SEGMENT = "_segment"
#: The folder below a table's location that holds swaps to be done; Spark does not read folders of such names as data.
PENDING = "_pending"


def save_table(df: DataFrame, table: str, layout: Layout = Layout(), path: str | None = None) -> None:
    """Create ``table`` from ``df`` in the shared folder."""
    path = path or new_path(df.sparkSession, table.split(".")[-1])
    writer(df, layout).option("path", path).saveAsTable(table)


def location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'")
    return rows.first()["data_type"]


def append(df: DataFrame, table: str) -> None:
    """Add rows; columns go by name. In a segmented table they are new segments."""
    settle(df.sparkSession, table)
    columns = df.sparkSession.table(table).columns
    if SEGMENT in columns and SEGMENT not in df.columns:
        df = df.withColumn(SEGMENT, _new_segment(pieces_of(df), F.spark_partition_id()))
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"rows for {table} lack {absent}")
    df.select(*columns).write.insertInto(table)


def stored_layout(spark: SparkSession, table: str) -> Layout:
    """How the table is stored by the catalog: its partition columns, or its bucket column and number of buckets."""
    columns = spark.catalog.listColumns(table)
    parts = tuple(c.name for c in columns if c.isPartition)
    buckets = [c.name for c in columns if c.isBucket]
    if not buckets:
        return Layout(partition_by=parts)
    if parts or len(buckets) > 1:
        raise ValueError(f"{table} is bucketed in a way that a layout cannot say")
    number = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Num Buckets'").first()["data_type"]
    return Layout(dist="key", key=buckets[0], buckets=int(number))


def obeyed(spark: SparkSession, table: str, layout: Layout) -> Layout:
    """``layout`` as it can be written to ``table``: partitions and buckets are the table's; order, encodings and codec are
    the caller's. A layout that says otherwise is an error, before anything is written."""
    stored = stored_layout(spark, table)
    if layout.partition_by and layout.partition_by != stored.partition_by:
        raise ValueError(f"{table} is partitioned by {stored.partition_by}, not by {layout.partition_by}")
    if layout.dist == "key" and (layout.key, layout.buckets or stored.buckets) != (stored.key, stored.buckets):
        raise ValueError(f"{table} has {stored.buckets} buckets of {stored.key}, not {layout.buckets} of {layout.key}")
    if stored.dist == "key":
        if layout.interleave or layout.dist in ("even", "all"):
            raise ValueError(f"{table} is bucketed by {stored.key}")
        return replace(layout, dist="key", key=stored.key, buckets=stored.buckets)
    return replace(layout, partition_by=stored.partition_by)


def publish(df: DataFrame, table: str, layout: Layout = Layout()) -> str:
    """Make ``df`` the new content of ``table`` and return the folder it replaced, which is left as it is.

    ``df`` may read the table. Partitions and buckets follow the table; ``layout`` adds order, encodings and codec.
    """
    spark = df.sparkSession
    settle(spark, table)
    layout, old = obeyed(spark, table, layout), location(spark, table)
    if layout.partition_by:
        replace_partitions(spark.table(table), df, table, layout)
        return old
    new, holder = new_path(spark, table.split(".")[-1]), new_name("incoming")
    try:
        save_table(df.select(*spark.table(table).columns), holder, layout, new)
        _statement(spark, f"ALTER TABLE {table} SET LOCATION '{new}'")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {holder}")
    spark.catalog.refreshTable(table)
    return old


def reencode(spark: SparkSession, table: str, encodings: dict[str, str], codec: str = "zstd") -> None:
    """Write the table again with other column encodings and codec; rows, partitions and buckets stay."""
    settle(spark, table)
    publish(spark.table(table), table, Layout(encodings=encodings, codec=codec))


def in_partitions(df: DataFrame, columns: list[str]) -> Column:
    """A predicate that holds exactly in the partitions ``df`` has rows in, and prunes directories.

    Only partition values travel through the driver: as many as the batch touches directories, which the catalog's
    statements need there in any case.
    """
    def within(values: list[tuple], names: list[str]) -> Column:
        """Grouped by the first column, so that the predicate stays small for many partitions."""
        first, rest = F.col(names[0]), names[1:]
        below: dict[object, list[tuple]] = {}
        for v in values:
            below.setdefault(v[0], []).append(v[1:])
        if not rest:
            known = first.isin([v for v in below if v is not None])
            return known | first.isNull() if None in below else known
        return reduce(lambda a, b: a | b, [first.eqNullSafe(F.lit(v)) & within(more, rest) for v, more in below.items()])
    found = [tuple(r) for r in df.select(*columns).distinct().collect()]
    return within(found, columns) if found else F.lit(False)


def _spec(folder: str, depth: int) -> str:
    """The partition a folder name like ``.../a=1/b=x`` stands for, as SQL."""
    parts = []
    for step in folder.split("/")[-depth:]:
        name, _, value = step.partition("=")
        text = unquote(value).replace("\\", "\\\\").replace("'", "\\'")
        parts.append(f"`{name}`=NULL" if value == "__HIVE_DEFAULT_PARTITION__" else f"`{name}`='{text}'")
    return ", ".join(parts)


#: New partitions that one catalog statement names.
STATEMENT_PARTITIONS = 200


class Interrupted(RuntimeError):
    """Raised in place of a catalog statement inside ``interrupted``."""


_statements_left: list[int] = []


@contextmanager
def interrupted(after: int):
    """Inside, the statements that make a change current fail once ``after`` of them have been done. To try what follows."""
    _statements_left.append(after)
    try:
        yield
    finally:
        _statements_left.pop()


def _statement(spark: SparkSession, text: str) -> None:
    if _statements_left:
        if _statements_left[-1] == 0:
            raise Interrupted(text)
        _statements_left[-1] -= 1
    spark.sql(text)


def _swap(spark: SparkSession, table: str, places: list[tuple[str, str]]) -> None:
    """Point partitions (spec, folder) at their folders. The folders that were current before stay on disk.

    The pairs are written below the table's location first; from then on the swap will be done, if not by this call then
    by ``settle``.
    """
    entry = f"{location(spark, table)}/{PENDING}/{time.time_ns():020d}-{uuid.uuid4().hex}"
    (spark.createDataFrame(places, "spec STRING, folder STRING").coalesce(1).write
     .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(entry))
    _replay(spark, table, entry)


def _replay(spark: SparkSession, table: str, entry: str) -> None:
    """Do a swap that is written down, from the start: new partitions are added, then each one is pointed at its folder. Every
    statement may be repeated, and none takes a partition away."""
    pairs = spark.read.schema("spec STRING, folder STRING").parquet(entry).orderBy("spec").collect()
    quoted = [(r["spec"], r["folder"].replace("\\", "\\\\").replace("'", "\\'")) for r in pairs]
    for k in range(0, len(quoted), STATEMENT_PARTITIONS):
        _statement(spark, f"ALTER TABLE {table} ADD IF NOT EXISTS " + " ".join(
            f"PARTITION ({spec}) LOCATION '{folder}'" for spec, folder in quoted[k:k + STATEMENT_PARTITIONS]))
    for spec, folder in quoted:
        _statement(spark, f"ALTER TABLE {table} PARTITION ({spec}) SET LOCATION '{folder}'")
    spark.catalog.refreshTable(table)
    remove_folder(spark, entry)


def settle(spark: SparkSession, table: str) -> int:
    """Finish the swaps that failed runs have left behind, oldest first, and return how many there were. A swap whose pairs
    were not written to the end was never decided, and is none. Whatever changes a table through this module does this
    first; a reader after a failure may, to see the change as a whole."""
    entries = [e for e in subfolders(spark, f"{location(spark, table)}/{PENDING}") if exists(spark, f"{e}/_SUCCESS")]
    for entry in entries:
        _replay(spark, table, entry)
    return len(entries)


def overwrite_partitions(df: DataFrame, table: str, layout: Layout = Layout()) -> list[tuple[str, str]]:
    """Replace exactly the partitions ``df`` has rows in, and return them as (spec, folder).

    The new files go to a folder of their own, so ``df`` may read the table and a failed write changes nothing. Then the
    catalog is pointed at it, partition by partition. A failure on the way leaves some partitions old and some new, none
    absent, until the swap is finished: see ``settle``.
    """
    settle(df.sparkSession, table)
    spark, layout = df.sparkSession, obeyed(df.sparkSession, table, layout)
    places = _written_partitions(df, layout)
    _swap(spark, table, places)
    return places


def _written_partitions(df: DataFrame, layout: Layout) -> list[tuple[str, str]]:
    spark, new = df.sparkSession, new_path(df.sparkSession, "partitions")
    writer(df, layout).save(new)
    # A listing, reduced on the executors to one name per partition written.
    folders = file_sizes(spark, new).select(F.regexp_replace("path", "/[^/]*$", "").alias("folder")).distinct()
    return [(_spec(r["folder"], len(layout.partition_by)), r["folder"]) for r in folders.collect()
            if "=" in r["folder"].rsplit("/", 1)[-1]]


def save_segmented(df: DataFrame, table: str, layout: Layout = Layout(), path: str | None = None) -> None:
    """Create ``table`` from ``df`` in segments of one file each, in the order of ``layout.sort`` or clustered by
    ``layout.interleave``; there are ``layout.files`` of them, or as many as its size asks for."""
    if layout.partition_by or layout.dist not in ("auto", "even"):
        raise ValueError("a segmented table has no partitions or buckets of its own")
    save_table(_segmented(df, layout), table, replace(layout, partition_by=(SEGMENT,), sort=(), interleave=(), files=None), path)


def _segmented(df: DataFrame, layout: Layout) -> DataFrame:
    files = layout.files or files_of(df)
    placed = arrange(df, replace(layout, files=files, dist="auto" if layout.sort or layout.interleave else "even"))
    return placed.withColumn(SEGMENT, _new_segment(files, F.spark_partition_id()))


def _new_segment(segments: int, number: Column) -> Column:
    """Names of up to ``segments`` segments that no other write gives."""
    return F.concat(F.lit(f"{uuid.uuid4().hex[:12]}-"), F.pmod(number, F.lit(segments)).cast("string"))


def rows_of(spark: SparkSession, table: str) -> DataFrame:
    """The rows of a table after any swap that is still to be done, without the column of segments."""
    settle(spark, table)
    return spark.table(table).drop(SEGMENT)


def resegment(spark: SparkSession, table: str, layout: Layout = Layout()) -> None:
    """Write a segmented table again in segments of full size and in its order: many small upserts leave small segments."""
    settle(spark, table)
    before = spark.table(table)
    replace_partitions(before, _segmented(before.drop(SEGMENT), layout), table,
                       Layout(encodings=layout.encodings, codec=layout.codec))


def upsert_table(source: DataFrame, table: str, keys: list[str], update_cols: list[str],
                 touch: dict[str, Column] | None = None, newer: str | list[str] | None = None, layout: Layout = Layout(),
                 check: bool = True) -> None:
    """Upsert into a table. In a partitioned one only partitions are read and rewritten that the batch has rows in or that
    hold one of its keys; a key whose partition differs from its old one moves there. In a segmented one only segments are
    that hold one of its keys; new keys become new segments. A table with neither is written again as a whole."""
    spark = source.sparkSession
    settle(spark, table)
    target, layout = spark.table(table), obeyed(spark, table, layout)
    parts = list(layout.partition_by)
    if not parts:
        publish(upsert(target, source, keys, update_cols, touch, newer, check=check), table, layout)
        return
    changed = [*update_cols, *[p for p in parts if p not in (*update_cols, *keys, SEGMENT)]]
    touched = target.where(in_partitions(held_partitions(target, source, keys, parts), parts))
    result = upsert(touched, source, keys, changed, touch, newer, check=check)
    replace_partitions(touched, named_segments(result, source, keys), table, layout)


def named_segments(rows: DataFrame, added: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` of a segmented table with new segments for those that have none: as many as the ``added`` rows fill."""
    if SEGMENT not in rows.columns:
        return rows
    return rows.withColumn(SEGMENT, F.coalesce(SEGMENT, _new_segment(pieces_of(added), F.xxhash64(*keys))))


def held_partitions(target: DataFrame, source: DataFrame, keys: list[str], parts: list[str]) -> DataFrame:
    """The partitions that the source has rows in, and those where the target holds its keys; only key and partition
    columns are read. If the partition columns are keys, a key cannot have moved. Segments are the target's alone."""
    wanted = source.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_{k}") for k in keys])
    holding = target.select(*dict.fromkeys([*keys, *parts])).join(wanted, same, "left_semi").select(*parts)
    if parts == [SEGMENT]:
        return holding
    own = source.select(*[F.col(p).cast(target.schema[p].dataType).alias(p) for p in parts])
    if set(parts) <= set(keys):
        return own
    return own.unionByName(holding)


def delete_from(spark: SparkSession, table: str, predicate: Column, layout: Layout = Layout()) -> None:
    """Delete rows. In a partitioned or segmented table only partitions or segments that hold such rows are rewritten."""
    settle(spark, table)
    rows, layout = spark.table(table), obeyed(spark, table, layout)
    if layout.partition_by:
        touched = rows.where(in_partitions(rows.where(predicate), list(layout.partition_by)))
        replace_partitions(touched, delete_where(touched, predicate), table, layout)
    else:
        publish(delete_where(rows, predicate), table, layout)


def replace_partitions(before: DataFrame, after: DataFrame, table: str, layout: Layout = Layout()) -> None:
    """Write ``after`` over the partitions of ``before`` and its own; a partition that ends up empty is pointed at an empty
    folder of its own. ``before`` names them as they are in the table; ``after`` may read it."""
    spark = before.sparkSession
    layout = obeyed(spark, table, layout)
    parts = list(layout.partition_by)
    had = [tuple(r) for r in before.select(*[F.col(c).cast("string") for c in parts]).distinct().collect()]
    places = _written_partitions(after.select(*spark.table(table).columns), layout)
    written, nothing = {spec for spec, _ in places}, new_path(spark, "empty")
    for number, values in enumerate(had):
        steps = [f"{c}={'__HIVE_DEFAULT_PARTITION__' if v is None else quote(v, safe=' ')}" for c, v in zip(parts, values)]
        spec = _spec("/".join(steps), len(parts))
        if spec not in written:
            places.append((spec, make_folder(spark, f"{nothing}/{number}")))
    if places:
        _swap(spark, table, places)
