"""A multi-column clustering code: each column becomes a bucket number, and the bits of the numbers are interleaved."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .numbering import with_running_total


def bucket_of(col: Column, bounds: list) -> Column:
    """Number of ``bounds`` that are at or below the value; NULL falls in bucket 0."""
    hits = [F.when(col >= F.lit(b), F.lit(1)).otherwise(F.lit(0)) for b in bounds]
    total = F.lit(0)
    for hit in hits:
        total = total + hit
    return total


def interleave_code(columns: list[tuple[Column, list]], bits: int) -> Column:
    """Interleave the ``bits`` low bits of each column's bucket number, first column most significant."""
    code = F.lit(0).cast("bigint")
    width = len(columns)
    for place, (col, bounds) in enumerate(columns):
        if len(bounds) >= 1 << bits:
            raise ValueError(f"{len(bounds)} bounds do not fit {bits} bits")
        bucket = bucket_of(col, bounds).cast("bigint")
        for bit in range(bits):
            one = F.shiftright(bucket, bit).bitwiseAND(F.lit(1).cast("bigint"))
            code = code.bitwiseOR(F.shiftleft(one, bit * width + (width - 1 - place)))
    return code


def _text_bounds(df: DataFrame, columns: list[str], shares: list[float]) -> dict[str, list]:
    """The values of every column at the given shares of its sorted rows, from counts per distinct value of all columns in one
    long form and one running total over it: only these values come back, and a value that fills the table is one row."""
    cells = F.explode(F.array(*[F.struct(F.lit(k).alias("_column"), F.col(c).alias("_value")) for k, c in enumerate(columns)]))
    counts = (df.select(cells.alias("_cell")).select("_cell.*").where(F.col("_value").isNotNull())
              .groupBy("_column", "_value").agg(F.count(F.lit(1)).alias("_n")))
    placed = with_running_total(counts, ["_column", "_value"], "_n", "_before")
    spans = placed.groupBy("_column").agg(F.min("_before").alias("first"), F.sum("_n").alias("n")).collect()
    wanted = [(r["_column"], r["first"] + int(share * (r["n"] - 1))) for r in spans for share in shares]
    if not wanted:
        return {c: [] for c in columns}
    hit = reduce(lambda a, b: a | b, [(F.lit(at) >= F.col("_before")) & (F.lit(at) < F.col("_before") + F.col("_n")) for _, at in wanted])
    rows = placed.where(hit).select("_column", "_value").collect()
    return {c: [r["_value"] for r in rows if r["_column"] == k] for k, c in enumerate(columns)}


def quantile_bounds(df: DataFrame, columns: list[str], bits: int) -> list[list]:
    """Bucket bounds per column; a few values come back to the driver. The bounds only decide where rows are stored, never
    which rows there are, so for numbers and times a sketch is enough; text, which the sketch does not take, is counted."""
    parts = 1 << bits
    shares = [i / parts for i in range(1, parts)]
    text = [c for c in columns if isinstance(df.schema[c].dataType, T.StringType)]
    other = [c for c in columns if c not in text]
    found = _text_bounds(df, text, shares) if text else {}
    if other:
        row = df.agg(*[F.percentile_approx(c, shares, 1000).alias(c) for c in other]).first()
        found.update({c: row[c] or [] for c in other})
    return [sorted(set(found[c])) for c in columns]
