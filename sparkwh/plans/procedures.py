"""The load and upkeep procedures on catalog tables: each computes rows with ``operators`` and makes them current."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.scalars import ts
from ..operators import loads
from ..operators.filters import none_like
from ..operators.upkeep import MAX_DELETED_SHARE, MIN_DELETED, analyze_table
from ..session import new_path, stage
from . import jobs
from .layout import Layout
from .tables import (SEGMENT, append, held_partitions, in_partitions, named_segments, obeyed, publish, replace_partitions,
                     settle)
from .upkeep import compact, selective_compact

LOADED = "loaded_at"


def _add(rows: DataFrame, table: str, as_of: str) -> None:
    """Append, with the load time and NULL for whatever else the table has and the rows have not."""
    target = rows.sparkSession.table(table)
    extra = {LOADED: ts(as_of)} if LOADED in target.columns else {}
    append(loads.shaped_like(rows, target, extra), table)


def load_by_timestamp(source: DataFrame, table: str, ts_col: str, as_of: str, **options) -> None:
    """Append what is later than the table's mark; see ``loads.incremental_by_timestamp`` for the options."""
    _add(loads.incremental_by_timestamp(source, source.sparkSession.table(table), ts_col, as_of, **options), table, as_of)


def load_by_id(source: DataFrame, table: str, id_col: str, as_of: str, fill_gaps: bool = False) -> None:
    """Append what is above the table's largest id."""
    _add(loads.incremental_by_id(source, source.sparkSession.table(table), id_col, fill_gaps), table, as_of)


def load_delta(source: DataFrame, table: str, keys: list[str], version_col: str, as_of: str, tiebreak: list[str],
               **options) -> None:
    """Append the newest recent versions the table does not hold yet; see ``loads.delta_load`` for the options."""
    target = source.sparkSession.table(table)
    _add(loads.delta_load(source, target, keys, version_col, as_of, tiebreak, **options), table, as_of)


def load_in_batches(source: DataFrame, table: str, id_col: str, as_of: str, batch_size: int = 1000,
                    run_log: str | None = None, name: str = "batches") -> str:
    """Append what is above the table's largest id, batch by batch, and return the run log's path."""
    spark = source.sparkSession
    if run_log is None:
        run_log = new_path(spark, "run_log")
        jobs.new_run_log(spark, run_log)
    target = spark.table(table)
    extra = {LOADED: ts(as_of)} if LOADED in target.columns else {}
    numbered = loads.batch_assign(source, target, id_col, batch_size)
    numbered = loads.shaped_like(numbered, target.withColumn("batch_no", F.lit(0).cast("bigint")), extra)
    jobs.load_batches(stage(numbered, "batches"), table, id_col, run_log, name, as_of)
    return run_log


def load_changes(source: DataFrame, table: str, staging: str, keys: list[str], compare: list[str],
                 update_cols: list[str], as_of: str, layout: Layout = Layout(), keep_staged: str = "1 HOUR",
                 **options) -> None:
    """Classify the source against the table, note the changes in the staging table, apply them, and purge old notes.

    The changes are noted before they are applied, so a failure between loses no record of them; a run that is repeated with
    the same ``as_of`` notes none of them twice. Only this run's changes are applied, so what an earlier run noted is not
    applied twice. See ``loads.classify_changes`` for the options.
    """
    spark = source.sparkSession
    settle(spark, table)
    target, layout = spark.table(table), obeyed(spark, table, layout)
    parts = list(layout.partition_by)
    classified = loads.classify_changes(source, target, keys, compare, as_of, **options)
    changes = stage(classified.where(F.col("operation_type") != "UNCHANGED"), "changes")
    touch = {LOADED: ts(as_of)} if LOADED in target.columns else {}
    noted = spark.table(staging).where(F.col("processed_at") == ts(as_of))
    append(_not_noted(changes, noted, [*keys, "operation_type"]), staging)
    if parts:
        update_cols = [*update_cols, *[p for p in parts if p not in (*update_cols, *keys, SEGMENT)]]
        touched = target.where(in_partitions(held_partitions(target, changes, keys, parts), parts))
        after = loads.apply_changes(touched, changes, keys, update_cols, touch)
        replace_partitions(touched, named_segments(after, changes, keys), table, layout)
    else:
        publish(loads.apply_changes(target, changes, keys, update_cols, touch), table, layout)
    publish(loads.purge_staging(spark.table(staging), as_of, keep_staged), staging)


def _not_noted(changes: DataFrame, staged: DataFrame, columns: list[str]) -> DataFrame:
    """The changes that staging does not have yet, by ``columns``, of which any may be NULL."""
    there = staged.select(*[F.col(c).alias(f"_{c}") for c in columns]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns])
    return changes.join(there, same, "left_anti")


def maintain(spark: SparkSession, tables: dict[str, Column], layouts: dict[str, Layout] | None = None,
             columns: dict[str, list[str]] | None = None) -> None:
    """Compact and analyze every table. ``tables`` gives each its "is deleted" predicate, ``columns`` those to profile."""
    for table, deleted in tables.items():
        compact(spark, table, (layouts or {}).get(table, Layout()), deleted)
        analyze_table(spark, table)
        if columns and table in columns:
            analyze_table(spark, table, columns[table])


def maintain_by_count(spark: SparkSession, tables: dict[str, Column], layouts: dict[str, Layout] | None = None,
                      min_deleted: int = MIN_DELETED) -> DataFrame:
    """Compact and analyze the tables with more deleted rows than that; a report."""
    return selective_compact(spark, tables, layouts, min_deleted=min_deleted)


def maintain_by_share(spark: SparkSession, tables: dict[str, Column], layouts: dict[str, Layout] | None = None,
                      share: float = MAX_DELETED_SHARE) -> DataFrame:
    """Compact and analyze the tables with a larger share of deleted rows than that; a report."""
    return selective_compact(spark, tables, layouts, ratio=share)


def maintain_schema(spark: SparkSession, database: str, deleted: dict[str, Column], exclude: list[str] | None = None,
                    share: float = MAX_DELETED_SHARE) -> DataFrame:
    """Compact and analyze the tables of a database with a larger share of deleted rows than that; a report.

    The tables are found in the catalog; names that fit a LIKE pattern of ``exclude`` are left out. ``deleted`` gives a table's
    "is deleted" predicate; tables without one hold no deleted rows and are only counted.
    """
    names = spark.createDataFrame([(t.name,) for t in spark.catalog.listTables(database)
                                   if not t.isTemporary and t.tableType != "VIEW"], "name string")
    chosen = none_like(names, "name", exclude) if exclude else names
    tables = {f"{database}.{r['name']}": deleted.get(r["name"], F.lit(False)) for r in chosen.orderBy("name").collect()}
    report = selective_compact(spark, tables, ratio=share)
    return report.withColumn("table_name", F.substring_index("table_name", ".", -1))
