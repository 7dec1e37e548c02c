"""Dense numbering and running totals over a global order, without a single-task window.

Rows are range-partitioned and sorted once, and written with their place in their partition. Totals per partition are
then one small table (at most one row per range partition); its running sum gives every partition its offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stage

# monotonically_increasing_id() keeps the partition in the upper bits and the row within it in the lower 33.
_ROW_BITS = 33


def range_sorted(df: DataFrame, order_by: list[Column | str]) -> DataFrame:
    """Stage ``df`` in global order with ``_part`` (range partition) and ``_row`` (0-based place in it)."""
    at = F.monotonically_increasing_id()
    placed = (
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_at", at)
        .withColumn("_part", F.shiftright("_at", _ROW_BITS))
        .withColumn("_row", F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
        .drop("_at")
    )
    return stage(placed, "ordered")


def _offsets(placed: DataFrame, total: Column) -> DataFrame:
    """Total of all earlier range partitions; one row per range partition, so the plain window is bounded."""
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return placed.groupBy("_part").agg(total.alias("_total")).select(
        "_part", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))


def with_position(df: DataFrame, order_by: list[Column | str], name: str = "position") -> DataFrame:
    """Add the 0-based place of each row in the order; ``order_by`` must be total for a repeatable result."""
    placed = range_sorted(df, order_by)
    offsets = F.broadcast(_offsets(placed, F.count(F.lit(1))))
    return (placed.join(offsets, "_part")
            .withColumn(name, F.col("_offset") + F.col("_row"))
            .select(*df.columns, name))


def with_running_total(df: DataFrame, order_by: list[Column | str], weight: str, name: str = "before") -> DataFrame:
    """Add the total ``weight`` of all rows that come strictly earlier in the order."""
    placed = range_sorted(df, order_by)
    offsets = F.broadcast(_offsets(placed, F.sum(weight)))
    inside = Window.partitionBy("_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    return (placed.join(offsets, "_part")
            .withColumn(name, F.col("_offset") + F.coalesce(F.sum(weight).over(inside), F.lit(0)))
            .select(*df.columns, name))


def with_previous(df: DataFrame, order_by: list[Column | str], columns: list[str]) -> DataFrame:
    """Add ``_prev`` (struct of ``columns`` in the preceding row, NULL for the very first row of all)."""
    placed = range_sorted(df, order_by)
    packed = F.struct(*columns)
    last = placed.groupBy("_part").agg(F.max_by(packed, F.col("_row")).alias("_last"))
    # One row per range partition: the last row of the partition before it.
    carried = last.select("_part", F.lag("_last").over(Window.orderBy("_part")).alias("_carried"))
    inside = Window.partitionBy("_part").orderBy("_row")
    # The window has already brought the rows together by _part, so this join moves only the few carried rows.
    return (placed.withColumn("_inside", F.lag(packed).over(inside))
            .join(carried, "_part")
            .withColumn("_prev", F.when(F.col("_row") == 0, F.col("_carried")).otherwise(F.col("_inside")))
            .select(*df.columns, "_prev"))


def assign_identity(df: DataFrame, order_by: list[Column | str], start: int = 1, step: int = 1,
                    name: str = "identity") -> DataFrame:
    """A dense surrogate key: ``start``, ``start + step``, ... in the given order."""
    numbered = with_position(df, order_by, "_position")
    return numbered.withColumn(name, F.lit(start) + F.col("_position") * F.lit(step)).drop("_position")
