"""Identity keys across loads: every load claims a range of its own in a small ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.numbering import assign_identity
from ..operators.joins import missing
from ..session import exists, stage
from .tables import append

_LEDGER = "load_id STRING, first BIGINT, row_count BIGINT"


def claims(spark: SparkSession, ledger: str) -> DataFrame:
    """``load_id, first, row_count`` of every load so far; ``ledger`` is a folder, which need not exist yet."""
    return spark.read.schema(_LEDGER).parquet(ledger) if exists(spark, ledger) else spark.createDataFrame([], _LEDGER)


def claim(spark: SparkSession, ledger: str, load_id: str, row_count: int, start: int = 1) -> int:
    """The first key of a range of ``row_count`` keys for ``load_id``: the one claimed by an earlier run of this load, else the
    next after all that are claimed. One load at a time may claim."""
    there = claims(spark, ledger)
    mine = there.where(F.col("load_id") == load_id).first()
    if mine is not None:
        if mine["row_count"] != row_count:
            raise ValueError(f"load {load_id} has claimed {mine['row_count']} keys, not {row_count}")
        return mine["first"]
    first = there.agg(F.coalesce(F.max(F.col("first") + F.col("row_count")), F.lit(start))).first()[0]
    spark.createDataFrame([(load_id, first, row_count)], _LEDGER).coalesce(1).write.mode("append").parquet(ledger)
    return first


def load_with_identity(rows: DataFrame, table: str, ledger: str, load_id: str, order_by: list[Column | str], name: str = "row_key",
                       start: int = 1) -> int:
    """Append ``rows`` with dense keys from this load's own range, in the order given, and return the first key.

    The range is claimed before anything is written. A load that is run again under its ``load_id`` gets the same range and,
    with an ``order_by`` that is total, the same keys; of its rows only those are added whose key the table lacks, so a run
    that broke off is completed and one that did not adds nothing. Ranges are never given twice, also if their rows are gone.
    """
    spark = rows.sparkSession
    numbered = stage(assign_identity(rows, order_by, 0, 1, name), "numbered")
    again = claims(spark, ledger).where(F.col("load_id") == load_id).count() > 0
    first = claim(spark, ledger, load_id, numbered.count(), start)
    numbered = numbered.withColumn(name, F.col(name) + F.lit(first))
    append(missing(numbered, spark.table(table), [name]) if again else numbered, table)
    return first
