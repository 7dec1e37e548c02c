"""Whole jobs: extract, transform and load as one chain of DataFrames, row metrics, batches, and the run log."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..functions.scalars import ts, whole_seconds
from ..operators.joins import missing
from ..operators.loads import daily_transform, upsert
from ..session import stage
from ..sources.files import extract
from .layout import Layout
from .tables import append, upsert_table

RUN_LOG_SCHEMA = ("pipeline STRING, task STRING, status STRING, start_time TIMESTAMP_NTZ, end_time TIMESTAMP_NTZ, "
                  "retry_count INT, error_message STRING, rows BIGINT")
SALES_UPDATE = ["customer_id", "product_id", "sale_amount", "sale_date", "region", "store_id"]


def with_metrics(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count the rows as they pass through the job's own action; no second scan."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def load_with_metrics(df: DataFrame, table: str, as_of: str) -> DataFrame:
    """Append and report ``target, records_loaded, load_time``."""
    counted, seen = with_metrics(df, f"load_{table}")
    append(counted, table)
    return df.sparkSession.range(1).select(
        F.lit(table).alias("target"), F.lit(seen.get["rows"]).cast("bigint").alias("records_loaded"),
        ts(as_of).alias("load_time"))


def sql_transform(spark: SparkSession, text: str, args: dict | None = None, **frames: DataFrame) -> DataFrame:
    """A transform given as SQL: ``:name`` takes a value from ``args``, ``{name}`` a DataFrame."""
    if not text:
        raise ValueError("a SQL transform needs SQL")
    return spark.sql(text, args=args or {}, **frames)


def fn_transform(df: DataFrame, fn: Callable[..., DataFrame], **params) -> DataFrame:
    """A transform given as a function from DataFrame to DataFrame."""
    return df.transform(fn, **params)


def daily_sales_job(spark: SparkSession, source: str, target: DataFrame, as_of: str, fmt: str = "parquet",
                    prepare: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The day's sales merged into the warehouse table: extract, keep and stamp recent sales, upsert by sale."""
    staging = extract(spark, source, fmt=fmt)
    staging = staging.transform(prepare) if prepare else staging
    return upsert(target, daily_transform(staging, as_of), ["sale_id"], SALES_UPDATE, {"updated_at": ts(as_of)})


def logged(spark: SparkSession, run_log: str, pipeline: str, task: str, work: Callable[[], int | None]) -> int | None:
    """Do one step, which returns its number of rows, and note how it went; a failure is noted and raised again."""
    def now() -> str:
        return datetime.now(timezone.utc).replace(tzinfo=None).isoformat()
    begin = now()
    try:
        rows = work()
    except Exception as error:
        log_step(spark, run_log, pipeline, task, "failed", begin, now(), error=str(error).split("\n", 1)[0])
        raise
    log_step(spark, run_log, pipeline, task, "completed", begin, now(), rows)
    return rows


def daily_sales_load(spark: SparkSession, source: str, table: str, as_of: str, run_log: str, fmt: str = "parquet",
                     layout: Layout = Layout()) -> None:
    """The daily job on a catalog table, with its steps in the run log. The day's rows are counted while they are
    staged, and staged so that the source is read once."""
    name, held = "daily_sales", {}

    def transform() -> int:
        counted, seen = with_metrics(daily_transform(extract(spark, source, fmt=fmt), as_of), f"{name}_{as_of}")
        held["day"] = stage(counted, "day")
        return seen.get["rows"]

    def load() -> int:
        upsert_table(held["day"], table, ["sale_id"], SALES_UPDATE, {"updated_at": ts(as_of)}, layout=layout)
        return held["rows"]
    held["rows"] = logged(spark, run_log, name, "transform", transform)
    logged(spark, run_log, name, "load", load)


def load_batches(assigned: DataFrame, table: str, id_col: str, run_log: str, name: str, as_of: str) -> None:
    """Append each batch of ``operators.loads.batch_assign`` as its own commit, noting it in the run log at ``run_log``.

    A run that stops half-way goes on, when called again with the same staged batches, after the last batch noted. The
    first batch not noted may have been written all the same, so it is compared with the table.
    """
    spark = assigned.sparkSession
    log = spark.read.schema(RUN_LOG_SCHEMA).parquet(run_log)
    done = {r["task"] for r in log.where((F.col("pipeline") == name) & (F.col("status") == "completed"))
            .select("task").collect()}
    last = assigned.agg(F.max("batch_no")).first()[0]
    doubtful = bool(done)
    for batch in range(0 if last is None else last + 1):
        task = f"batch_{batch}"
        if task in done:
            continue
        rows = assigned.where(F.col("batch_no") == batch)
        if doubtful:
            rows, doubtful = missing(rows, spark.table(table), [id_col]), False
        rows, seen = with_metrics(rows, f"{name}_{task}")
        append(rows, table)
        log_step(spark, run_log, name, task, "completed", as_of, as_of, seen.get["rows"])


def log_step(spark: SparkSession, run_log: str, pipeline: str, task: str, status: str, start: str, end: str | None,
             rows: int | None = None, error: str | None = None, retries: int = 0) -> None:
    """Add one row to the run log."""
    def time(text: str | None) -> datetime | None:
        return datetime.fromisoformat(text) if text else None
    (spark.createDataFrame([(pipeline, task, status, time(start), time(end), retries, error, rows)], RUN_LOG_SCHEMA)
     .coalesce(1).write.mode("append").parquet(run_log))


def new_run_log(spark: SparkSession, run_log: str) -> None:
    """An empty run log."""
    spark.createDataFrame([], RUN_LOG_SCHEMA).write.parquet(run_log)


def run_details(run_log: DataFrame) -> DataFrame:
    """Status, duration, retries and error of every step."""
    return run_log.select("pipeline", "task", "status", "start_time", "end_time",
                          whole_seconds(F.col("start_time"), F.col("end_time")).alias("duration_seconds"), "retry_count",
                          "error_message", "rows")


def run_summary(run_log: DataFrame) -> DataFrame:
    """One row per pipeline: overall status, span, and steps by outcome."""
    def number(status: str):
        return F.count_if(F.col("status") == status)
    total, completed, failed = F.count(F.lit(1)), number("completed"), number("failed")
    grouped = run_log.groupBy("pipeline").agg(
        F.min("start_time").alias("start_time"), F.max("end_time").alias("end_time"),
        total.alias("total_tasks"), completed.alias("completed_tasks"), failed.alias("failed_tasks"),
        F.sum("rows").alias("rows"))
    status = (F.when(F.col("failed_tasks") > 0, "failed")
              .when(F.col("completed_tasks") == F.col("total_tasks"), "completed")
              .when(F.col("start_time").isNull(), "pending").otherwise("running"))
    return grouped.select(F.col("pipeline").alias("pipeline_name"), status.alias("status"), "start_time", "end_time",
                          whole_seconds(F.col("start_time"), F.col("end_time")).alias("duration_seconds"), "total_tasks",
                          "completed_tasks", "failed_tasks", "rows")
