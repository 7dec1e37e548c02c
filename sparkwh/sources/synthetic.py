"""Synthetic sales and fact rows, one per id of an id column.

Values come from multiplicative hashes of the id, so a row is the same wherever and whenever it is made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.scalars import seconds, ts

# Odd multipliers, one per generated column, and the range each hash is taken over.
MULTIPLIERS = (7919, 104729, 1299709, 15485863, 32452843, 49979687, 67867967)
MODULUS = 1_000_003
ID_RANGE = 2_147_483_647
YEAR_SECONDS = 365 * 24 * 60 * 60


def row_ids(spark: SparkSession, n: int) -> DataFrame:
    """Ids 1..n, made on the executors."""
    return spark.range(1, n + 1)


def _unit(seed: int, k: int) -> Column:
    """Hash number ``k`` of the id, 0..MODULUS-1. Taking the id modulo ID_RANGE first keeps the product in a long."""
    return F.pmod(F.pmod(F.col("id"), F.lit(ID_RANGE)) * MULTIPLIERS[k] + (seed + k) * 12_345, F.lit(MODULUS))


def _scaled(seed: int, k: int, top: int) -> Column:
    """The hash spread over 0..top-1 with whole-number arithmetic."""
    return F.call_function("div", _unit(seed, k) * top, F.lit(MODULUS))


def generate_sales(ids: DataFrame, seed: int, as_of: str) -> DataFrame:
    """Sales in the year before ``as_of``: regions 30/30/40 %, one in ten inactive."""
    share = _scaled(seed, 4, 100)
    return ids.select(
        F.col("id").alias("sale_id"),
        F.concat(F.lit("PROD_"), _scaled(seed, 0, 1000).cast("string")).alias("product_id"),
        F.concat(F.lit("CUST_"), _scaled(seed, 1, 1000).cast("string")).alias("customer_id"),
        (_scaled(seed, 2, 100_000).cast("decimal(10,2)") / 100).cast("decimal(10,2)").alias("sale_amount"),
        (ts(as_of) - seconds(_scaled(seed, 3, YEAR_SECONDS))).alias("sale_date"),
        F.when(share < 30, "West").when(share < 60, "East").otherwise("Central").alias("region"),
        _scaled(seed, 5, 100).cast("int").alias("store_id"),
        (_scaled(seed, 6, 10) != 0).alias("is_active"))


def generate_facts(ids: DataFrame, seed: int, as_of: str) -> DataFrame:
    """Facts in the year before ``as_of``: four even categories, two even source systems."""
    quarter = _scaled(seed, 3, 4)
    return ids.select(
        F.col("id").alias("fact_id"),
        F.concat(F.lit("DIM_"), _scaled(seed, 0, 500).cast("string")).alias("dimension_id"),
        (_scaled(seed, 1, 10_000_000).cast("decimal(12,4)") / 10_000).cast("decimal(12,4)").alias("metric_value"),
        (ts(as_of) - seconds(_scaled(seed, 2, YEAR_SECONDS))).alias("timestamp"),
        F.when(quarter == 0, "A").when(quarter == 1, "B").when(quarter == 2, "C").otherwise("D").alias("category"),
        F.when(_scaled(seed, 4, 2) == 0, "SYS1").otherwise("SYS2").alias("source_system"))
