"""Reports over any span from sketches kept per period: rows are read once, late ones add sketches of their own.

The stored rows add up: two of one period and group, from two loads, give the same report as one over both loads' rows,
up to the stated errors. Counts, sums and extremes stay exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.scalars import trunc_ts, ts
from .reports import mean

# A percentile's rank is wrong by more than 0.35 % of the rows once in a hundred times with this size of sketch.
RANK_SIZE = 800
RANK_ERROR = 0.0035
# Distinct counts have a standard error of 1.04 / sqrt(2 ** DISTINCT_BITS), here 1.6 %.
DISTINCT_BITS = 12
DISTINCT_ERROR = 1.04 / 2 ** (DISTINCT_BITS / 2)

_COUNTABLE = (T.IntegerType, T.LongType, T.StringType, T.BinaryType)
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def period_sketches(rows: DataFrame, unit: str, time_col: str, group: list[str], measure: str, distinct: str) -> DataFrame:
    """``period``, the group, ``row_count, measured, total, least, most, ranks, members`` per period and group: a quantile sketch
    of ``measure`` and a distinct-count sketch of ``distinct``, NULLs left out of both. Tasks sketch before the shuffle, so a group
    with a third of all rows costs a sketch per task. Whole numbers are kept as such, any other measure as double."""
    whole = isinstance(rows.schema[measure].dataType, _WHOLE)
    value = F.col(measure).cast("bigint" if whole else "double")
    member = F.col(distinct) if isinstance(rows.schema[distinct].dataType, _COUNTABLE) else F.col(distinct).cast("string")
    ranks = (F.kll_sketch_agg_bigint if whole else F.kll_sketch_agg_double)(value, F.lit(RANK_SIZE))
    return rows.groupBy(trunc_ts(unit, F.col(time_col)).alias("period"), *group).agg(
        F.count(F.lit(1)).alias("row_count"), F.count(value).alias("measured"), F.sum(value).alias("total"),
        F.min(value).alias("least"), F.max(value).alias("most"), ranks.alias("ranks"),
        F.hll_sketch_agg(member, F.lit(DISTINCT_BITS)).alias("members"))


def merged_sketches(kept: DataFrame, by: list[str]) -> DataFrame:
    """One row per value of ``by`` with the stored figures added up; ``period`` among them joins what several loads left of it."""
    whole = isinstance(kept.schema["least"].dataType, T.LongType)
    merge = F.kll_merge_agg_bigint if whole else F.kll_merge_agg_double
    return kept.groupBy(*by).agg(
        *[F.sum(c).alias(c) for c in ("row_count", "measured", "total")], F.min("least").alias("least"), F.max("most").alias("most"),
        merge("ranks").alias("ranks"), F.hll_union_agg("members").alias("members"))


def span_report(kept: DataFrame, unit: str, start: str, end: str, group: list[str], p: float) -> DataFrame:
    """Per group over the periods from ``start`` to before ``end``: ``row_count, average, least, most``, exact, and ``percentile`` and
    ``distinct`` from the sketches. Both ends must be borders of periods, as a stored period cannot be cut: else an error at run
    time. A group without measured values has NULL for them."""
    low, high = ts(start), ts(end)
    message = F.lit(f"{start} and {end} must be borders of a {unit}")
    borders = (trunc_ts(unit, low) == low) & (trunc_ts(unit, high) == high)
    chosen = kept.where((F.col("period") >= low) & (F.col("period") < high)).where(
        F.when(borders, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
    whole = isinstance(kept.schema["least"].dataType, T.LongType)
    quantile = (F.kll_sketch_get_quantile_bigint if whole else F.kll_sketch_get_quantile_double)("ranks", F.lit(p))
    return merged_sketches(chosen, group).select(
        *group, "row_count", mean(F.col("total"), F.col("measured")).alias("average"), "least", "most",
        F.when(F.col("measured") > 0, quantile).alias("percentile"), F.hll_sketch_estimate("members").alias("distinct"))


def rank_is_near(below: Column, upto: Column, n: Column, p: float, error: float = 3 * RANK_ERROR) -> Column:
    """Whether a value with ``below`` of ``n`` rows under it and ``upto`` rows at or under it is the percentile up to the error."""
    return (below / n - F.lit(error) <= F.lit(p)) & (upto / n + F.lit(error) >= F.lit(p))
