"""Report queries over transactions and batches, and the small relational pieces they share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scalars import int_ratio, trunc_ts
from .filters import recent

MONEY = "decimal(20,2)"


def mean(total: Column, n: Column) -> Column:
    """Average as a double from an exact sum."""
    return total.cast("double") / n


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """First ``k`` rows of an order; Spark keeps ``k`` rows per task and merges them."""
    return df.orderBy(*order).limit(k)


def top_by_sum(df: DataFrame, key: str, amount: str, ts_col: str, as_of: str, span: str, status: str,
               k: int = 100) -> DataFrame:
    """Keys with the largest recent total in one status."""
    chosen = recent(df, ts_col, as_of, span).where(F.col("status") == status)
    sums = chosen.groupBy(key).agg(
        F.sum(amount).cast(MONEY).alias("total_transactions"),
        F.count(F.lit(1)).alias("transaction_count"),
        F.max(ts_col).alias("last_transaction"))
    return top_k(sums, [F.col("total_transactions").desc_nulls_first(), F.col(key)], k)


def period_report(df: DataFrame, unit: str, ts_col: str, amount: str, as_of: str, span: str) -> DataFrame:
    """Count, sum and mean per period, newest first."""
    total, n = F.sum(amount), F.count(F.lit(1))
    return (recent(df, ts_col, as_of, span)
            .groupBy(trunc_ts(unit, F.col(ts_col)).alias(f"transaction_{unit}"))
            .agg(n.alias("daily_transactions"), total.cast(MONEY).alias("daily_amount"),
                 mean(total, F.count(amount)).alias("avg_transaction_amount"))
            .orderBy(F.col(f"transaction_{unit}").desc()))


def throughput(df: DataFrame, n: str, secs: str, name: str = "records_per_second") -> DataFrame:
    """Whole records per second; NULL where no second has passed."""
    return df.withColumn(name, int_ratio(F.col(n), F.col(secs)))


def high_water_mark(df: DataFrame, col: str) -> DataFrame:
    """One row: the largest value of a column, NULL for an empty table."""
    return df.agg(F.max(col).alias("high_water_mark"))


def latest_version(df: DataFrame, keys: list[str], version_col: str, tiebreak: list[str]) -> DataFrame:
    """Newest row per key; ``tiebreak`` must make equal versions distinct.

    Spark limits each key to one row per task before the shuffle, so a key with very many versions stays cheap.
    """
    order = [F.col(version_col).desc_nulls_last()] + [F.col(c).desc_nulls_last() for c in tiebreak]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def keyset_page(df: DataFrame, id_col: str, last_id: int, n: int) -> DataFrame:
    """The next ``n`` rows after ``last_id``."""
    return top_k(df.where(F.col(id_col) > last_id), [F.col(id_col)], n)
