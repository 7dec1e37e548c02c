"""Joins between sources, targets and dimensions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.scalars import interval, row_hash
from ..session import planned_bytes, stage

# A side that is called small may read so many bytes at most.
SMALL_BYTES = 512 * 1024 * 1024


def checked_small(df: DataFrame) -> DataFrame:
    """``df`` to be broadcast, after a look at what its plan reads: more than ``SMALL_BYTES`` is an error. What no statistics
    tell is written to the shared folder, and its size seen there."""
    size = planned_bytes(df)
    if size is None:
        df = stage(df, "small")
        size = planned_bytes(df)
    if size is None or size > SMALL_BYTES:
        raise ValueError(f"a side of {size} bytes is not small")
    return F.broadcast(df)


def matching_keys(target: DataFrame, source: DataFrame, keys: list[str], small: bool = False) -> DataFrame:
    """Distinct keys of the target; with ``small``, for a source that fits every task (see ``checked_small``), only those it
    asks for.

    The keys of a small source are broadcast: the target is scanned, key columns only, and nothing of it is shuffled.
    Else the target's keys are made distinct before they are shuffled, so a hot key is one row per task; adaptive execution
    still broadcasts what turns out small.
    """
    found = asked_for(target.select(*keys), source, keys, small).distinct()
    return F.broadcast(found) if small else found


def existing(source: DataFrame, target: DataFrame, keys: list[str], small: bool = False) -> DataFrame:
    """Source rows whose key is in the target."""
    return source.join(matching_keys(target, source, keys, small), keys, "left_semi")


def missing(source: DataFrame, target: DataFrame, keys: list[str], small: bool = False) -> DataFrame:
    """Source rows whose key is not in the target."""
    return source.join(matching_keys(target, source, keys, small), keys, "left_anti")


def asked_for(target: DataFrame, source: DataFrame, keys: list[str], small: bool = False) -> DataFrame:
    """The target, cut down to the keys of a source that is ``small``."""
    return target.join(checked_small(source.select(*keys)), keys, "left_semi") if small else target


def missing_within(source: DataFrame, target: DataFrame, keys: list[str], version_col: str, target_version_col: str,
                   tolerance: str, small: bool = False) -> DataFrame:
    """Source rows for which the target has no row of the same key at or after ``version - tolerance``.

    Only the newest target version of a key can decide that, so the target shrinks to one row per key and task before it
    is shuffled, and a key with very many versions never meets its partners pair by pair.
    """
    newest = (asked_for(target.select(*keys, target_version_col), source, keys, small)
              .groupBy(*keys).agg(F.max(target_version_col).alias("_newest")))
    s, t = source.alias("s"), newest.alias("t")
    on = reduce(lambda a, b: a & b, [F.col(f"s.{k}") == F.col(f"t.{k}") for k in keys])
    return s.join(t, on & (F.col("t._newest") >= F.col(f"s.{version_col}") - interval(tolerance)), "left_anti")


def broadcast_dim(fact: DataFrame, dim: DataFrame, on: list[str], how: str = "inner", small: bool = False) -> DataFrame:
    """Join with a dimension. Spark broadcasts it where its measured size allows that; ``small`` asks for it, within
    ``SMALL_BYTES``."""
    return fact.join(checked_small(dim) if small else dim, on, how)


def hot_keys(df: DataFrame, key: str, share: float) -> list:
    """Keys that hold more than ``share`` of the rows; there can be at most ``1 / share`` of them."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("_t"))  # the same aggregation, which Spark does once
    chosen = counts.where(F.col(key).isNotNull() & (F.col("_n") > total.scalar() * share))
    return [r[0] for r in chosen.select(key).collect()]


def colocated_join(spark: SparkSession, left_table: str, right_table: str, on: str, how: str = "inner",
                   hot_share: float = 0.05, salts: int = 32) -> DataFrame:
    """Join two tables bucketed alike on ``on``: bucket meets bucket, nothing is shuffled.

    Keys that hold more than ``hot_share`` of either table would fill one bucket's task; only their rows leave the buckets.
    The side on which such a key is hot is spread over ``salts`` tasks, and the other side's rows meet it in each; where it
    is hot on both, the rows are dealt over a square of tasks, so neither side is copied ``salts`` times.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"join type {how} cannot be salted on the left side")
    left, right = spark.table(left_table), spark.table(right_table)
    hot_left, hot_right = (set(hot_keys(side, on, hot_share)) for side in (left, right))
    hot = sorted(hot_left | hot_right)
    if not hot:
        return left.join(right, on, how)
    is_hot = F.col(on).isin(hot)
    parts = [left.where(~is_hot | F.col(on).isNull()).join(right.where(~is_hot), on, how)]
    side = max(2, round(salts ** 0.5))
    for keys, a, b in ((hot_left - hot_right, salts, 1), (hot_right - hot_left, 1, salts), (hot_left & hot_right, side, side)):
        # A left join must see all partners of a left row in one task, so there the left side alone is dealt out.
        across, down = (a, b) if how == "inner" else (salts, 1)
        if keys:
            own = F.col(on).isin(sorted(keys))
            parts.append(_dealt(left.where(own), across, down, True).join(
                _dealt(right.where(own), across, down, False), [on, "_a", "_b"], how).drop("_a", "_b"))
    return reduce(lambda x, y: x.unionByName(y), parts)


def _dealt(rows: DataFrame, across: int, down: int, left: bool) -> DataFrame:
    """Rows dealt by hash along their own axis and copied along the other one."""
    own, other = (across, down) if left else (down, across)
    place = F.pmod(row_hash(rows.columns), F.lit(own)).cast("int")
    copy = F.explode(F.sequence(F.lit(0), F.lit(other - 1)))
    mine, theirs = ("_a", "_b") if left else ("_b", "_a")
    return rows.withColumn(mine, place).withColumn(theirs, copy)


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that break a primary key: more than one row, or a NULL part."""
    has_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
            .withColumn("reason", F.when(has_null, "null key").when(F.col("row_count") > 1, "duplicate key"))
            .where(F.col("reason").isNotNull()))
