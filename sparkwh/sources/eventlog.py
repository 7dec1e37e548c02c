"""The query log of a Spark cluster, read from its event logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.scalars import seconds, ts
from ..session import stage

# Only the fields used below; everything else in an event is skipped by the JSON reader.
_EVENT_SCHEMA = """
  `Event` STRING, `executionId` BIGINT, `description` STRING, `time` BIGINT,
  `Job ID` BIGINT, `Stage IDs` ARRAY<BIGINT>, `Stage ID` BIGINT,
  `Properties` STRUCT<`spark.sql.execution.id`: STRING, `spark.scheduler.pool`: STRING>,
  `Task Metrics` STRUCT<
    `Peak Execution Memory`: BIGINT, `Memory Bytes Spilled`: BIGINT, `Disk Bytes Spilled`: BIGINT,
    `Input Metrics`: STRUCT<`Bytes Read`: BIGINT, `Records Read`: BIGINT>>
"""
_SQL = "org.apache.spark.sql.execution.ui.SparkListenerSQLExecution"
_BLOCK_BYTES = 1_048_576


def load_query_log(spark: SparkSession, path: str) -> DataFrame:
    """One row per SQL execution: text, scheduler pool, times, rows and bytes read, peak memory, spilled blocks."""
    event = F.col("Event")
    # The text is parsed once; the few fields of the few kinds of event that matter are then read several times.
    events = stage(spark.read.schema(_EVENT_SCHEMA).json(path)
                   .where(event.isin(_SQL + "Start", _SQL + "End", "SparkListenerJobStart", "SparkListenerTaskEnd"))
                   .withColumn("app", F.regexp_replace(F.input_file_name(), r"^.*/|\.inprogress$", "")), "events")
    started = events.where(event == _SQL + "Start").select(
        "app", F.col("executionId").alias("query_id"), F.col("description").alias("query"),
        F.col("time").alias("start_ms"))
    ended = events.where(event == _SQL + "End").select(
        "app", F.col("executionId").alias("query_id"), F.col("time").alias("end_ms"))
    stages = (events.where(event == "SparkListenerJobStart")
              .select("app", F.col("Properties.`spark.sql.execution.id`").cast("bigint").alias("query_id"),
                      F.col("Properties.`spark.scheduler.pool`").alias("pool"),
                      F.explode("Stage IDs").alias("stage"))
              .where(F.col("query_id").isNotNull()))
    metrics = F.col("Task Metrics")
    # Task events are by far the most; they shrink to one row per stage before they meet anything else.
    per_stage = (events.where(event == "SparkListenerTaskEnd")
                 .groupBy("app", F.col("Stage ID").alias("stage"))
                 .agg(F.sum(metrics["Input Metrics"]["Records Read"]).alias("rows"),
                      F.sum(metrics["Input Metrics"]["Bytes Read"]).alias("bytes"),
                      F.max(metrics["Peak Execution Memory"]).alias("workmem"),
                      F.sum(metrics["Disk Bytes Spilled"]).alias("spilled")))
    # A stage reused by a later job is listed by both; its tasks ran for the first.
    owner = stages.groupBy("app", "stage").agg(F.min("query_id").alias("query_id"), F.max("pool").alias("pool"))
    work = (owner.join(per_stage, ["app", "stage"], "left")
            .groupBy("app", "query_id")
            .agg(F.max("pool").alias("pool"), F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"),
                 F.max("workmem").alias("workmem"), F.sum("spilled").alias("spilled")))
    zero = F.lit(0).cast("bigint")

    def at(column: str):
        return ts("1970-01-01") + seconds(F.col(column).cast("decimal(18,3)") / 1000)

    return (started.join(ended, ["app", "query_id"], "left").join(work, ["app", "query_id"], "left")
            .select("app", "query_id", "query", F.coalesce("pool", F.lit("default")).alias("service_class"),
                    at("start_ms").alias("start_time"), at("end_ms").alias("end_time"),
                    (F.col("end_ms") - F.col("start_ms")).alias("total_time"),
                    F.coalesce("rows", zero).alias("rows"), F.coalesce("bytes", zero).alias("bytes"),
                    F.coalesce("workmem", zero).alias("workmem"),
                    F.ceil(F.coalesce("spilled", zero) / _BLOCK_BYTES).alias("temp_blocks"),
                    F.lit(False).alias("is_rrscan")))
