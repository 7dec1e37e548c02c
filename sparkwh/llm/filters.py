"""A membership filter of fixed size, to leave out rows before a shuffle. It may let a row through, never lose one.

Most stages of a corpus pipeline drop few documents. ``split`` lets all rows whose id is surely not among the given ones pass
without a shuffle; only the others need a join.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from .batches import tidy


FILTER_BITS = 1 << 26  # 8 MB, whatever the number of keys


def key_filter(keys: DataFrame, bits: int = FILTER_BITS) -> Broadcast:
    """A bit map of the long column ``key``. Its words are joined by Spark; at most ``bits`` bits reach the driver."""
    at = F.pmod(F.col("key"), F.lit(bits))
    words = (keys.where("key is not null").select(F.shiftright(at, 5).cast("int").alias("word"), at.bitwiseAND(F.lit(31)).cast("int").alias("bit"))
             .select("word", F.expr("shiftleft(1L, bit)").alias("mask"))
             .groupBy("word").agg(F.bit_or("mask").alias("mask")))
    found = words.toArrow()
    table = np.zeros(bits // 32, np.uint32)
    table[found.column("word").to_numpy()] = found.column("mask").to_numpy().astype(np.uint32)
    return keys.sparkSession.sparkContext.broadcast(table)


def may_hold(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the filter may hold the signed 64-bit ``keys``."""
    at = (keys.astype(np.int64) % np.int64(len(table) * 32)).astype(np.int64)
    return ((table[at >> 5] >> (at & 31).astype(np.uint32)) & np.uint32(1)).astype(bool)




def split(docs: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose ``doc_id`` is surely not among the long column ``key`` of ``keys`` (or NULL), and those where it may be."""
    table, at = key_filter(keys), docs.columns.index("doc_id")

    def rows(wanted: bool):
        def run(batches):
            for batch in batches:
                ids = batch.column(at)
                held = may_hold(table.value, ids.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)) & ids.is_valid().to_numpy(zero_copy_only=False)
                yield batch.filter(pa.array(held == wanted))
        return run

    return docs.mapInArrow(tidy(rows(False)), docs.schema), docs.mapInArrow(tidy(rows(True)), docs.schema)


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows whose ``doc_id`` is not in the long column ``doc_id`` of ``dropped``; rows with NULL ``doc_id`` stay."""
    sure, maybe = split(docs, dropped.select(F.col("doc_id").alias("key")))
    return sure.unionByName(maybe.join(dropped.select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns))
