"""Column profiles: distinct counts, common values, correlation with row order, and the encoding they suggest."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.numbering import with_position, with_previous, with_running_total
from ..session import stage

# Limits of the encoding rules.
RUN_SHARE = 0.1
DICT_SHARE = 0.1
SORTED_SHARE = 0.9
LONG_TEXT = 255


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """``column_name, value, value_count``; values as text, NULL included. Equal values meet before the shuffle."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], columns, "column_name", "value")
    return long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("value_count"))


def _ranked(counts: DataFrame, k: int) -> DataFrame:
    """The ``k`` most common values per column; Spark keeps ``k`` per column and task before the shuffle."""
    by_count = Window.partitionBy("column_name").orderBy(F.col("value_count").desc(), F.col("value"))
    return (counts.where(F.col("value").isNotNull()).withColumn("rank", F.row_number().over(by_count))
            .where(F.col("rank") <= k))


def most_common_values(df: DataFrame, columns: list[str], k: int = 10) -> DataFrame:
    """The ``k`` most common values of each column with their share of all rows."""
    total = df.agg(F.count(F.lit(1)).alias("_n")).scalar()
    return _ranked(value_counts(df, columns), k).select(
        "column_name", "rank", "value", "value_count",
        F.round(F.col("value_count") / total, 6).alias("frequency"))


def _correlations(df: DataFrame, columns: list[str], place: str) -> DataFrame:
    """Correlation of each column's rank with the row order; equal values share the mean of their ranks.

    Rows shrink to one per column and distinct value, with the sums that a correlation needs, before anything is sorted.
    The distinct values of all columns are ranked in one global order of (column, value): a value sits in the slot of its own
    type, so it sorts as that type. The ranks of a column start somewhere in the middle, which a correlation ignores.
    """
    types = list(dict.fromkeys(df.schema[c].dataType.simpleString() for c in columns))
    slots = [f"_v{i}" for i in range(len(types))]

    def entry(c: str) -> Column:
        own = df.schema[c].dataType.simpleString()
        values = [(F.col(c) if t == own else F.lit(None).cast(t)).alias(s) for s, t in zip(slots, types)]
        return F.struct(F.lit(c).alias("column_name"), *values)
    known = reduce(lambda a, b: a | b, [F.col(s).isNotNull() for s in slots])
    at = F.col("_at")
    counts = (df.select(F.col(place).cast("double").alias("_at"), F.inline(F.array(*[entry(c) for c in columns]))).where(known)
              .groupBy("column_name", *slots).agg(F.count(F.lit(1)).alias("_n"), F.sum(at).alias("_x"), F.sum(at * at).alias("_xx")))
    ranked = with_running_total(counts, ["column_name", *slots], "_n", "_before")
    rank = F.col("_before") + (F.col("_n") + 1) / 2
    n, x, y = F.sum("_n"), F.sum("_x"), F.sum(F.col("_n") * rank)
    cov = F.sum(F.col("_x") * rank) / n - x / n * (y / n)
    var_x, var_y = F.sum("_xx") / n - x / n * (x / n), F.sum(F.col("_n") * rank * rank) / n - y / n * (y / n)
    return ranked.groupBy("column_name").agg(
        F.round(cov / F.sqrt(F.nullif(var_x * var_y, F.lit(0.0))), 6).alias("correlation"))


def profile_of_counts(counts: DataFrame, k: int = 10) -> DataFrame:
    """Distinct count, share of NULLs and common values per column from ``value_counts``, which are read twice."""
    total = F.sum("value_count")
    basic = counts.groupBy("column_name").agg(
        F.count("value").alias("n_distinct"),
        F.round(F.sum(F.when(F.col("value").isNull(), F.col("value_count")).otherwise(0)) / total, 6)
        .alias("null_fraction"),
        total.alias("_rows"))
    common = _ranked(counts, k).groupBy("column_name").agg(
        F.sort_array(F.collect_list(F.struct("rank", "value", "value_count"))).alias("_top"))
    return basic.join(common, "column_name", "left").select(
        "column_name", "n_distinct", "null_fraction",
        F.transform("_top", lambda v: v["value"]).alias("most_common_vals"),
        F.transform("_top", lambda v: F.round(v["value_count"] / F.col("_rows"), 6)).alias("most_common_freqs"))


def added_counts(kept: DataFrame) -> DataFrame:
    """``value_counts`` of a whole table from those of its parts, whatever else tells the parts apart: the rows themselves are not
    read again. Values that all parts had lost would not occur, as each part's counts hold what it has now."""
    return kept.groupBy("column_name", "value").agg(F.sum("value_count").alias("value_count"))


def column_profile(df: DataFrame, columns: list[str], order_by: list[str] | None = None, k: int = 10) -> DataFrame:
    """Distinct count, share of NULLs, correlation with the row order ``order_by`` (which must be total; without it the
    correlation is left NULL), and the most common values with their shares."""
    out = profile_of_counts(stage(value_counts(df, columns), "counts"), k)
    if order_by is None:
        return out.withColumn("correlation", F.lit(None).cast("double"))
    placed = with_position(df.select(*dict.fromkeys([*columns, *order_by])), order_by, "_place")
    correlations = _correlations(placed, columns, "_place")
    return out.join(correlations, "column_name", "left")


def approximate_profile(df: DataFrame, columns: list[str], k: int = 10) -> DataFrame:
    """``column_profile`` from sketches in one pass without a shuffle of values; no correlation."""
    pieces = []
    for c in columns:
        pieces += [F.approx_count_distinct(c).alias(f"d_{c}"),
                   F.call_function("approx_top_k", F.col(c).cast("string"), F.lit(k)).alias(f"t_{c}"), F.count(c).alias(f"n_{c}")]
    row = df.agg(F.count(F.lit(1)).alias("_rows"), *pieces)
    each = F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.col(f"d_{c}").alias("n_distinct"),
        F.round(1 - F.col(f"n_{c}") / F.col("_rows"), 6).alias("null_fraction"),
        F.transform(f"t_{c}", lambda v: v["item"]).alias("most_common_vals"),
        F.transform(f"t_{c}", lambda v: F.round(v["count"] / F.col("_rows"), 6)).alias("most_common_freqs"))
        for c in columns])
    return row.select(F.inline(each))


def _ordered(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType))


def _suggestion(kind: Column) -> Column:
    runs = F.col("run_count") / F.col("row_count")
    distinct = F.col("n_distinct") / F.col("row_count")
    return (F.when(kind == "boolean", "RUNLENGTH")
            .when((kind == "text") & (F.col("mean_length") > LONG_TEXT), "ZSTD")  # whatever its cardinality
            .when(runs < RUN_SHARE, "RUNLENGTH")
            .when((kind == "ordered") & (F.col("rising_share") >= SORTED_SHARE), "DELTA")
            .when((kind == "text") & (distinct < DICT_SHARE), "BYTEDICT")
            .otherwise("TEXT255"))


def encoding_profile(df: DataFrame, columns: list[str], order_by: list[str]) -> DataFrame:
    """Per column, in the stored order: distinct values, runs of equal values, share of steps that do not fall, mean
    text length, and the encoding that suits them."""
    walked = with_previous(df.select(*dict.fromkeys([*columns, *order_by])), order_by, columns)
    aggregates, rows = [F.count(F.lit(1)).alias("_rows")], []
    for i, c in enumerate(columns):
        data_type = df.schema[c].dataType
        now, before = F.col(c), F.col("_prev")[c]
        starts = F.col("_prev").isNull() | ~now.eqNullSafe(before)
        rising = F.count_if(now >= before) if _ordered(data_type) else F.lit(None).cast("bigint")
        pairs = F.count(now >= before) if _ordered(data_type) else F.lit(None).cast("bigint")
        aggregates += [F.count_if(starts).alias(f"r{i}"), rising.alias(f"u{i}"), pairs.alias(f"p{i}"),
                       F.avg(F.length(now.cast("string"))).alias(f"l{i}")]
        kind = ("boolean" if isinstance(data_type, T.BooleanType)
                else "ordered" if _ordered(data_type) else "text")
        rows.append(F.struct(
            F.lit(c).alias("column_name"), F.lit(kind).alias("_kind"), F.col("_rows").alias("row_count"),
            F.col(f"r{i}").alias("run_count"),
            F.round(F.col(f"u{i}") / F.nullif(F.col(f"p{i}"), F.lit(0)), 6).alias("rising_share"),
            F.round(f"l{i}", 4).alias("mean_length")))
    shape = walked.agg(*aggregates).select(F.inline(F.array(*rows)))
    distinct = value_counts(df, columns).groupBy("column_name").agg(F.count("value").alias("n_distinct"))
    return (shape.join(distinct, "column_name")
            .withColumn("suggested_encoding", _suggestion(F.col("_kind"))).drop("_kind"))
