"""Keys across loads, and batches as a stream."""

from __future__ import annotations

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from sparkwh.plans import identity, tables
from sparkwh.session import new_name, new_path
from sparkwh.streaming import loads as streams

from .conftest import rows


def part(spark, low, high):
    return spark.range(low, high).select(F.col("id").alias("k"))


def test_three_loads_one_of_them_twice(spark):
    table, ledger = new_name("t"), new_path(spark, "ledger")
    tables.save_table(part(spark, 0, 0).withColumn("row_key", F.lit(0).cast("bigint")), table)

    def load(name, low, high):
        return identity.load_with_identity(part(spark, low, high), table, ledger, name, ["k"])
    assert [load("a", 0, 10), load("b", 10, 25), load("b", 10, 25), load("c", 25, 30), load("a", 0, 10)] == [1, 11, 11, 26, 1]
    assert rows(spark.table(table)) == [(k, k + 1) for k in sorted(range(30), key=lambda k: repr((k, k + 1)))]
    with pytest.raises(ValueError, match="has claimed"):
        load("b", 10, 26)


def test_a_load_that_broke_off_is_completed(spark, monkeypatch):
    table, ledger = new_name("t"), new_path(spark, "ledger")
    tables.save_table(part(spark, 0, 0).withColumn("row_key", F.lit(0).cast("bigint")), table)

    def broken(df, name):
        tables.append(df.where("k < 4"), name)
        raise RuntimeError
    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(identity, "append", broken)
        identity.load_with_identity(part(spark, 0, 9), table, ledger, "a", ["k"])
    identity.load_with_identity(part(spark, 20, 22), table, ledger, "b", ["k"])
    identity.load_with_identity(part(spark, 0, 9), table, ledger, "a", ["k"])
    got = {r["k"]: r["row_key"] for r in spark.table(table).collect()}
    assert spark.table(table).count() == 11 and got == {**{k: k + 1 for k in range(9)}, 20: 10, 21: 11}


@pytest.mark.parametrize("after", [1, 2, 3])
def test_streamed_batches_add_nothing_twice(spark, after):
    path, mark, table = new_path(spark, "feed"), new_path(spark, "mark"), new_name("t")
    for k in range(3):
        part(spark, 10 * k, 10 * k + 10).coalesce(1).write.mode("append").parquet(path)
    tables.save_segmented(part(spark, 0, 0), table)

    def load():
        streams.stream_batches(streams.read_new_files(spark, path, "k BIGINT", maxFilesPerTrigger=1), table, mark)
    with pytest.raises(StreamingQueryException), tables.interrupted(after):
        load()
    load()
    load()
    assert rows(tables.rows_of(spark, table)) == rows(part(spark, 0, 30))
    assert spark.table(table).select(tables.SEGMENT).distinct().count() == 3
