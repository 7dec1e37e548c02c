"""A log of change batches, and a table rebuilt from it as of any batch."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.loads import one_row_per_key
from . import parts

BATCH = "batch_id"
KIND = "operation_type"


def record(changes: DataFrame, folder: str, keys: list[str], batch: int) -> None:
    """Keep one classified batch (see ``loads.classify_changes``) as number ``batch``. A batch that is recorded again replaces its
    earlier self. A key twice in it is an error; UNCHANGED rows are not kept."""
    if batch < 0:
        raise ValueError("batches are numbered from 0")
    parts.put(one_row_per_key(changes.where(F.col(KIND).isin("INSERT", "UPDATE", "DELETE")), keys), folder, batch, BATCH)


def recorded(spark: SparkSession, folder: str, schema: T.StructType | str) -> DataFrame:
    """All batches kept in ``folder``, whose changes have ``schema``, with their ``batch_id``."""
    return parts.kept(spark, folder, schema, BATCH, "BIGINT")


def _newest(log: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Per key ``_last`` (values of its newest change), ``_state`` (its newest INSERT or DELETE, NULL if it has none) and ``_gone``
    (whether it was deleted at any time). Changes of a key meet in the tasks first, so a key with very many stays cheap."""
    kind, batch = F.col(KIND), F.col(BATCH)
    return log.groupBy(*keys).agg(
        F.max_by(F.struct(*values), batch).alias("_last"), F.max_by(kind, F.when(kind != "UPDATE", batch)).alias("_state"),
        F.max(kind == "DELETE").alias("_gone"))


def rebuilt(base: DataFrame, log: DataFrame, keys: list[str], upto: int, after: int | None = None) -> DataFrame:
    """The table after batch ``upto``, from ``base``, which is its state after batch ``after`` (None: before all batches).

    Equals applying the batches one by one (``loads.apply_changes``) with all columns of the log that the base has, but each side is
    read and shuffled once, whatever the number of batches: only the newest change of a key counts, and its newest INSERT or
    DELETE tells whether it is there. An UPDATE of a key that is not there does nothing. Columns that the log lacks keep the base's
    value, and are NULL in rows added since. Rows with a NULL in their key meet nothing: those of the base stay, inserted ones are
    added. Of the log only the folders of batches after ``after`` and up to ``upto`` are read.
    """
    chosen = log.where(F.col(BATCH) <= upto)
    chosen = chosen if after is None else chosen.where(F.col(BATCH) > after)
    values = [c for c in base.columns if c in log.columns and c not in keys]
    none = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    newest = _newest(chosen.where(~none), keys, [*values, KIND]).withColumn("_new", F.lit(True))
    there = base.where(~none).withColumn("_old", F.lit(True))
    met = there.alias("t").join(newest.alias("c"), reduce(lambda a, b: a & b, [F.col(f"t.{k}") == F.col(f"c.{k}") for k in keys]), "full")
    old, new = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    stays = F.when(~new, F.lit(True)).when(F.col("_state").isNull(), old).otherwise(F.col("_state") == "INSERT")

    def result(field: T.StructField) -> Column:
        before = F.col(f"t.{field.name}")
        if field.name in keys:
            return F.coalesce(before, F.col(f"c.{field.name}").cast(field.dataType)).alias(field.name)
        if field.name in values:
            return F.when(new, F.col("_last")[field.name].cast(field.dataType)).otherwise(before).alias(field.name)
        return F.when(F.coalesce(F.col("_gone"), F.lit(False)), F.lit(None)).otherwise(before).cast(field.dataType).alias(field.name)
    state = met.where(stays).select(*[result(f) for f in base.schema.fields])
    added = chosen.where(none & (F.col(KIND) == "INSERT")).select(
        *[(F.col(f.name) if f.name in log.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in base.schema.fields])
    return state.unionByName(base.where(none)).unionByName(added)
