"""Reports over a query log (see ``sources.eventlog`` for the columns)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.scalars import interval, trunc_ts, ts
from ..session import stage
from .filters import recent
from .reports import mean, top_k

# Thresholds of the slow and the memory-heavy report, in milliseconds and bytes.
SLOW_MS = 5000
HEAVY_BYTES = 1_000_000
# One in so many ranks is the error of a group's sketch.
SKETCH = 10_000
# So many groups, of some hundred bytes each, are sent to every task at most.
BROADCAST_GROUPS = 100_000


def recent_queries(log: DataFrame, as_of: str, span: str, like: str | None = None) -> DataFrame:
    """Queries of the last span, newest first, optionally only those whose text matches."""
    chosen = recent(log, "start_time", as_of, span)
    if like is not None:
        chosen = chosen.where(F.col("query").like(like))
    return chosen.orderBy(F.col("start_time").desc(), F.col("query_id"))


def class_report(log: DataFrame, as_of: str, span: str) -> DataFrame:
    """Load per service class, slowest class first."""
    return (recent(log, "start_time", as_of, span).groupBy("service_class")
            .agg(F.count(F.lit(1)).alias("query_count"),
                 mean(F.sum("total_time"), F.count("total_time")).alias("avg_execution_time"),
                 F.max("total_time").alias("max_execution_time"),
                 F.sum("rows").alias("total_rows_processed"),
                 F.sum("bytes").alias("total_bytes_processed"))
            .orderBy(F.col("avg_execution_time").desc_nulls_first(), "service_class"))


def slow_queries(log: DataFrame, as_of: str, min_ms: int = SLOW_MS, k: int = 20, span: str = "1 HOUR") -> DataFrame:
    chosen = recent(log, "start_time", as_of, span).where(F.col("total_time") > min_ms)
    return top_k(chosen, [F.col("total_time").desc(), F.col("query"), F.col("query_id")], k)


def memory_heavy(log: DataFrame, as_of: str, min_bytes: int = HEAVY_BYTES, k: int = 20,
                 span: str = "1 HOUR") -> DataFrame:
    chosen = recent(log, "start_time", as_of, span).where(F.col("workmem") > min_bytes)
    return top_k(chosen, [F.col("workmem").desc(), F.col("query"), F.col("query_id")], k)


def maintenance_statements(log: DataFrame, as_of: str, span: str, strict: bool = False) -> DataFrame:
    """Maintenance statements. As the report is usually written, AND binds first and only ANALYZE statements are
    limited to the span; ``strict`` limits both kinds."""
    vacuum, analyze = F.col("query").like("%VACUUM%"), F.col("query").like("%ANALYZE%")
    late = F.col("start_time") > ts(as_of) - interval(span)
    chosen = (vacuum | analyze) & late if strict else vacuum | (analyze & late)
    return log.where(chosen).orderBy(F.col("start_time").desc(), F.col("query_id"))


def class_percentile(log: DataFrame, unit: str, p: float, as_of: str, span: str, approx: bool = False) -> DataFrame:
    """Count, mean and percentile of run time per period and class. The percentile interpolates between two ranks.

    A first pass takes, with the counts, a sketch per group and from it two values that bracket the ranks for sure. A second
    one counts the rows below the bracket and keeps counts of the distinct values inside, a few in ``SKETCH`` of the rows; in
    these the ranks are found. Both passes aggregate before they shuffle, so a group with a third of all queries costs no
    more than any other, and nothing is sorted globally. ``approx`` asks for Spark's sketch instead.
    """
    hour = trunc_ts(unit, F.col("start_time")).alias(unit)
    chosen = recent(log, "start_time", as_of, span).select(hour, "service_class", "total_time")
    group = [unit, "service_class"]
    average = mean(F.sum("total_time"), F.count("total_time")).alias("avg_execution_time")
    name = f"p{round(p * 100)}_execution_time"
    if approx:
        return (chosen.groupBy(*group).agg(F.count(F.lit(1)).alias("query_count"), average,
                                           F.percentile_approx("total_time", p).cast("double").alias(name)).orderBy(*group))
    low, high = max(0.0, p - 3 / SKETCH), min(1.0, p + 3 / SKETCH)
    groups = stage(chosen.groupBy(*group).agg(
        F.count(F.lit(1)).alias("query_count"), average, F.count("total_time").alias("_size"),
        F.percentile_approx("total_time", [low, high], SKETCH).alias("_band"),
        F.min("total_time").alias("_min"), F.max("total_time").alias("_max")), "groups")
    few = F.col("_size") <= SKETCH  # the bracket would be narrower than a rank or two
    least = F.col("_min") if low == 0 else F.when(few, F.col("_min")).otherwise(F.col("_band")[0])
    most = F.col("_max") if high == 1 else F.when(few, F.col("_max")).otherwise(F.col("_band")[1])
    bands = groups.where("_size > 0").select(*[F.col(c).alias(f"_{c}") for c in group], "_size", least.alias("_low"), most.alias("_high"))
    if bands.count() <= BROADCAST_GROUPS:
        bands = F.broadcast(bands)
    place = F.lit(p) * (F.col("_size") - 1)
    met = chosen.where(F.col("total_time").isNotNull()).join(bands, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in group])
    inside = (met.where("total_time <= _high").withColumn("_value", F.when(F.col("total_time") >= F.col("_low"), F.col("total_time")))
              .groupBy(*group, "_size", "_value").agg(F.count(F.lit(1)).alias("_n")))  # NULL: all that is below
    order = Window.partitionBy(*group).orderBy(F.col("_value").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    placed = inside.withColumn("_before", F.coalesce(F.sum("_n").over(order), F.lit(0)))

    def value_at(rank):
        return F.max(F.when((F.col("_before") <= rank) & (rank < F.col("_before") + F.col("_n")), F.col("_value")))

    picked = placed.groupBy(*group).agg(F.max(place).alias("_place"), value_at(F.floor(place)).alias("_lo"), value_at(F.ceil(place)).alias("_hi"))
    share = F.col("_place") - F.floor("_place")
    value = F.when(F.col("_lo").isNotNull() & F.col("_hi").isNotNull(), F.col("_lo") + share * (F.col("_hi") - F.col("_lo"))).otherwise(
        F.raise_error(F.lit("a percentile lies outside its bracket")).cast("double"))
    found = picked.select(*[F.col(c).alias(f"_{c}") for c in group], value.alias(name))
    return (groups.join(found, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in group], "left")
            .select(*group, "query_count", "avg_execution_time", name).orderBy(*group))
