"""Streaming loads. The checkpoint takes the place of the high-water mark: every file is processed once."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.scalars import seconds
from ..operators.reports import latest_version
from ..plans.layout import Layout
from ..plans.tables import SEGMENT, append, overwrite_partitions, upsert_table
from ..session import stage


def read_new_files(spark: SparkSession, path: str, schema, fmt: str = "parquet", **options: str) -> DataFrame:
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


def stream_append(rows: DataFrame, target: str, checkpoint: str) -> None:
    """Append everything that is new since the last run, then stop. The file sink's log keeps a repeated batch out."""
    (rows.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
     .outputMode("append").trigger(availableNow=True).start().awaitTermination())


def _run(rows: DataFrame, apply: Callable[[DataFrame, int], None], table: str, checkpoint: str) -> None:
    """Run every micro-batch that is due. Micro-batches have a session of their own, which knows nothing of what the caller's
    session does to the table, nor the other way round: each is told."""
    def fresh(batch: DataFrame, batch_id: int) -> None:
        batch.sparkSession.catalog.refreshTable(table)
        apply(batch, batch_id)
    (rows.writeStream.foreachBatch(fresh).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())
    rows.sparkSession.catalog.refreshTable(table)


def stream_latest_upsert(rows: DataFrame, table: str, keys: list[str], version_col: str, tiebreak: list[str],
                         update_cols: list[str], checkpoint: str, layout: Layout = Layout()) -> None:
    """Upsert the newest version per key of each micro-batch, then stop when nothing is left.

    A row already at that version or later stays, versions that tie being told apart by ``tiebreak`` as in the batch rule,
    so batches may come late, twice or in any order. Each micro-batch rewrites what it touches: few large batches, or a
    partitioned table, keep that small.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        newest = stage(latest_version(batch, keys, version_col, tiebreak), f"batch-{batch_id}")
        upsert_table(newest, table, keys, update_cols, newer=[version_col, *tiebreak], layout=layout, check=False)

    _run(rows, apply, table, checkpoint)


def stream_batches(rows: DataFrame, table: str, checkpoint: str, name: str = "batches") -> None:
    """Append everything that is new in micro-batches, each a commit of its own, then stop. How large they are, the source
    says (``maxBytesPerTrigger``, ``maxFilesPerTrigger``).

    The target is a segmented table; a micro-batch becomes the segment of its number, put in place by a swap. One that is
    repeated after a failure takes the place of what it had written, so nothing is added twice and nothing is compared.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        overwrite_partitions(batch.withColumn(SEGMENT, F.lit(f"{name}-{batch_id}")), table)

    _run(rows, apply, table, checkpoint)


def _known(keys: list[str], ts_col: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*keys, ts_col]])


def first_of_runs(rows: DataFrame, keys: list[str], ts_col: str, tolerance: int) -> DataFrame:
    """Rows without an earlier row of their key within ``tolerance`` seconds; of rows with equal times one stays."""
    before = F.lag(ts_col).over(Window.partitionBy(*keys).orderBy(ts_col))
    return rows.withColumn("_before", before).where(
        F.col("_before").isNull() | (F.col("_before") < F.col(ts_col) - seconds(F.lit(tolerance)))).drop("_before")


def missing_around(rows: DataFrame, target: DataFrame, keys: list[str], ts_col: str, tolerance: int) -> DataFrame:
    """Rows for which the target has no row of the same key within ``tolerance`` seconds before or after.

    Times are cut into steps of the tolerance. The target shrinks to the first and last time of each key and step before it
    is shuffled, and a row meets at most the three steps around its own, so a key with very many rows stays cheap.
    """
    at, span = F.col(ts_col), seconds(F.lit(tolerance))
    step = F.floor((F.datediff(at.cast("date"), F.lit("1970-01-01").cast("date")).cast("long") * 86_400
                    + F.hour(at) * 3_600 + F.minute(at) * 60 + F.second(at)) / tolerance)
    there = target.where(_known(keys, ts_col)).groupBy(*keys, step.alias("_step")).agg(F.min(ts_col).alias("_first"), F.max(ts_col).alias("_last"))
    near = (rows.select(*keys, ts_col, F.explode(F.sequence(step - 1, step + 1)).alias("_step")).join(there, [*keys, "_step"])
            .where((F.col("_last") >= at - span) & (F.col("_first") <= at + span)).select(*keys, ts_col).distinct())
    return rows.join(near, [*keys, ts_col], "left_anti")


def stream_dedup(rows: DataFrame, table: str, keys: list[str], ts_col: str, checkpoint: str, tolerance: int = 300) -> None:
    """Append rows whose key has none within ``tolerance`` seconds, in the table or earlier in the micro-batch, then stop.

    Comparing with the table, not with state that is let go, keeps late rows: they are dropped only if they repeat a row. A
    batch that is repeated after a failure finds its own rows and adds nothing. Rows with a NULL in key or time repeat nothing.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        known = first_of_runs(batch.where(_known(keys, ts_col)), keys, ts_col, tolerance)
        fresh = missing_around(known, batch.sparkSession.table(table), keys, ts_col, tolerance)
        append(stage(fresh.unionByName(batch.where(~_known(keys, ts_col))), f"batch-{batch_id}"), table)

    _run(rows, apply, table, checkpoint)
