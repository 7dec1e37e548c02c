"""Figures and change batches kept in a folder, one part per load: a part that is put again replaces its earlier self."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, types as T

from ..session import exists, subfolders

PART = "load_part"


def put(rows: DataFrame, folder: str, part: str | int, name: str = PART) -> None:
    """Write one part. A load that is run again under its name replaces its part, so nothing counts twice. One writer per part."""
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", str(part)):
        raise ValueError(f"not a name for a part: {part}")
    rows.write.mode("overwrite").parquet(f"{folder}/{name}={part}")


def kept(spark: SparkSession, folder: str, schema: T.StructType | str, name: str = PART, kind: str = "STRING") -> DataFrame:
    """All parts, with the part's name as the last column; no rows if there is none yet. A part whose ``put`` broke off is an
    error until it is put again: it lacks the mark that Spark leaves when a write is complete."""
    shape = schema if isinstance(schema, T.StructType) else spark.createDataFrame([], schema).schema
    shape = T.StructType([*shape.fields, *spark.createDataFrame([], f"{name} {kind}").schema.fields])
    parts = [p for p in subfolders(spark, folder) if p.rsplit("/", 1)[-1].startswith(f"{name}=")]
    broken = [p for p in parts if not exists(spark, f"{p}/_SUCCESS")]
    if broken:
        raise ValueError(f"not completely written, put again: {', '.join(broken)}")
    return spark.read.schema(shape).option("basePath", folder).parquet(*parts) if parts else spark.createDataFrame([], shape)
