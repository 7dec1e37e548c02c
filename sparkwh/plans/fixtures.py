"""Warehouse-shaped tables derived from the given Parquet tables by deterministic expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.scalars import seconds, ts
from ..session import app_id, new_path

ORDERS_NOW = "2001-07-01 00:00:00"
EVENTS_NOW = "2024-01-31 00:00:00"

SALES_SCHEMA = ("sale_id BIGINT, product_id STRING, customer_id STRING, sale_amount DECIMAL(10,2), "
                "sale_date TIMESTAMP_NTZ, region STRING, store_id INT, category STRING, is_active BOOLEAN")
SALES_CSV_SCHEMA = ("sale_id BIGINT, product_id STRING, customer_id STRING, sale_amount DECIMAL(10,2), "
                    "sale_date STRING, region STRING, store_id INT")
SALES_PART_SCHEMA = ("sale_id BIGINT, product_id STRING, customer_id STRING, sale_amount DECIMAL(10,2), "
                     "store_id INT, category STRING, sale_date DATE, region STRING")

_written: dict[tuple[str, str, str], str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """Path of a derived data set in the shared folder; written on first use in a session."""
    key = (app_id(spark), sf_dir, name)
    if key not in _written:
        path = new_path(spark, name)
        write(path)
        _written[key] = path
    return _written[key]


def forget() -> None:
    """Write derived data sets anew from here on."""
    _written.clear()


def src_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.concat(F.lit("CUST_"), F.col("o_custkey").cast("string")).alias("customer_id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("total_amount"),
        F.col("o_orderstatus").alias("status"),
        (F.col("o_orderdate") + seconds(F.col("o_orderkey") % 86400)).alias("created_at"))


def tgt_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("order_id")
    return src_orders(spark, sf_dir).where(key % 10 != 0).select(
        "order_id", "customer_id", "order_date",
        F.when(key % 11 == 0, (F.col("total_amount") + 1).cast("decimal(10,2)"))
        .otherwise(F.col("total_amount")).alias("total_amount"),
        F.when(key % 13 == 0, F.lit(None)).when(key % 7 == 0, F.lit("X")).otherwise(F.col("status")).alias("status"),
        "created_at")


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        key.alias("sale_id"),
        F.concat(F.lit("PROD_"), (key % 1000).cast("string")).alias("product_id"),
        F.concat(F.lit("CUST_"), F.col("o_custkey").cast("string")).alias("customer_id"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("sale_amount"),
        (F.col("o_orderdate") + seconds(key % 86400)).alias("sale_date"),
        F.when(key % 3 == 0, "West").when(key % 3 == 1, "East").otherwise("Central").alias("region"),
        (key % 101).cast("int").alias("store_id"),
        F.when(key % 4 == 0, "Electronics").when(key % 4 == 1, "Books").when(key % 4 == 2, "Toys")
        .otherwise("Food").alias("category"),
        (key % 10 != 0).alias("is_active"))


def sales_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales with text dates; a seventh of them carry no time of day and an eleventh are no date at all."""
    stamp = F.col("sale_date").cast("string")
    key = F.col("sale_id")
    return sales(spark, sf_dir).select(
        "sale_id", "product_id", "customer_id", "sale_amount",
        F.when(key % 11 == 0, "n/a").when(key % 7 == 0, F.substring(stamp, 1, 10)).otherwise(stamp).alias("sale_date"),
        "region", "store_id")


def sales_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales(spark, sf_dir).select(
        "sale_id", "product_id", "customer_id", "sale_amount", "store_id", "category",
        F.trunc("sale_date", "month").alias("sale_date"), "region")


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("fact_id"),
        F.concat(F.lit("DIM_"), F.col("user_id").cast("string")).alias("dimension_id"),
        F.col("value").cast("decimal(12,4)").alias("metric_value"),
        F.col("ts").alias("timestamp"),
        F.col("event_type").alias("category"),
        F.when(F.col("event_id") % 2 == 0, "SYS1").otherwise("SYS2").alias("source_system"))


def time_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.col("user_id")
    return table(spark, sf_dir, "events").select(
        F.col("ts").alias("timestamp"),
        F.col("value").cast("decimal(12,4)").alias("metric_value"),
        F.col("event_type").alias("metric_name"),
        F.concat(F.lit("DEV_"), user.cast("string")).alias("device_id"),
        F.when(user % 3 == 0, "north").when(user % 3 == 1, "south").otherwise("east").alias("location"))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("transaction_id"),
        F.concat(F.lit("CUST_"), F.col("o_custkey").cast("string")).alias("customer_id"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("amount"),
        F.col("o_orderdate").alias("transaction_date"),
        F.when(status == "F", "completed").when(status == "O", "open").otherwise("pending").alias("status"),
        F.col("o_orderpriority").alias("priority_level"))


def batch_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        event.alias("batch_id"),
        F.concat(F.lit("batch_"), F.col("user_id").cast("string")).alias("batch_name"),
        F.col("ts").alias("processing_date"),
        F.col("event_type").alias("status"),
        (event % 1000).cast("int").alias("records_processed"),
        (event % 7).cast("int").alias("processing_time_seconds"))


def query_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    event, kind = F.col("event_id"), F.col("event_id") % 8
    return table(spark, sf_dir, "events").select(
        event.alias("query_id"),
        F.when(kind == 0, "VACUUM sales").when(kind == 1, "ANALYZE sales")
        .when(kind == 2, "SELECT 1 FROM ext_sales_parquet").when(kind == 3, "DELETE FROM sales_with_deletes")
        .otherwise("SELECT 1").alias("query"),
        F.col("event_type").alias("service_class"),
        F.col("ts").alias("start_time"),
        (F.col("ts") + seconds(event % 60)).alias("end_time"),
        F.round(F.col("value") * 100).cast("bigint").alias("total_time"),
        F.col("user_id").alias("rows"),
        (event * 17).alias("bytes"),
        ((event * 7919) % 3000000).alias("workmem"),
        (event % 50).alias("temp_blocks"),
        (event % 2 == 0).alias("is_rrscan"))


def load_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("load_"), F.col("event_type")).alias("procedure_name"),
        F.col("ts").alias("call_time"),
        F.round(F.col("value") * 100).cast("bigint").alias("total_time"),
        F.col("event_id").alias("rows_processed"),
        (F.col("event_type") != "error").alias("success_flag"))


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    event, kind = F.col("event_id"), F.col("event_id") % 5
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("job_"), F.col("user_id").cast("string")).alias("pipeline"),
        F.concat(F.lit("step_"), event.cast("string")).alias("task"),
        F.when(kind == 0, "pending").when(kind == 1, "running").when(kind == 2, "completed")
        .when(kind == 3, "failed").otherwise("retrying").alias("status"),
        F.when(kind != 0, F.col("ts")).alias("start_time"),
        F.when(kind.isin(2, 3), F.col("ts") + seconds(event % 600)).alias("end_time"),
        (event % 4).cast("int").alias("retry_count"),
        F.when(kind == 3, F.col("event_type")).alias("error_message"),
        (event % 1000).alias("rows"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("CUST_"), F.col("c_custkey").cast("string")).alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_acctbal").cast("decimal(12,2)").alias("total_purchases"),
        F.col("c_nationkey").alias("preferred_store_id"))


def product_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The small dimension of product types."""
    return table(spark, sf_dir, "part").select(
        F.col("p_type").alias("category_id"),
        F.lower("p_type").alias("category_name"),
        F.upper("p_type").alias("department")).distinct()


def warehouse_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target of the daily job: older amounts, a tenth of the sales still missing."""
    return sales(spark, sf_dir).where("sale_id % 10 <> 0").select(
        "sale_id", "customer_id", "product_id",
        (F.col("sale_amount") + 1).cast("decimal(10,2)").alias("sale_amount"),
        "sale_date", "region", "store_id",
        F.lit(None).cast("timestamp_ntz").alias("processed_at"),
        ts("1994-12-31 00:00:00").alias("updated_at"))
