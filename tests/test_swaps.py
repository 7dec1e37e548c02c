"""Changes that are broken off before any of their catalog statements, and tables whose files are replaced one by one."""

from __future__ import annotations

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from sparkwh.functions.scalars import ts
from sparkwh.plans import procedures, tables, upkeep
from sparkwh.plans.layout import Layout
from sparkwh.session import exists, new_name, new_path, subfolders
from sparkwh.streaming import loads as streams

from .conftest import rows

NOW = "2024-01-01 00:00:00"


def items(spark, low, high, add=0):
    k = F.col("id")
    return spark.range(low, high).select(k, (k % 97 + add).cast("int").alias("v"), F.concat(F.lit("n'"), k % 2).alias("part"))


def fresh(spark):
    table = new_name("t")
    tables.save_table(items(spark, 0, 30), table, Layout(partition_by=("part",)))
    return table


def an_upsert(spark, table):
    moved = items(spark, 25, 32, 100).withColumn("part", F.when(F.col("id") == 26, "new").otherwise(F.col("part")))
    tables.upsert_table(moved, table, ["id"], ["v"])


def a_delete(spark, table):
    tables.delete_from(spark, table, (F.col("part") == "n'0") | (F.col("id") % 7 == 0))


def a_compaction(spark, table):
    upkeep.compact(spark, table, Layout(sort=("id",)), F.col("v") % 5 == 0)


def changes(staging):
    def run(spark, table):
        source = items(spark, 3, 33, 1).where("id % 4 <> 0 OR id > 28")
        procedures.load_changes(source, table, staging, ["id"], ["v"], ["v"], NOW, detect_deletes=True)
    return run


def a_stream(feed, mark):
    def run(spark, table):
        found = streams.read_new_files(spark, feed, "id BIGINT, v INT, part STRING", maxFilesPerTrigger=1)
        streams.stream_latest_upsert(found, table, ["id"], "v", ["id"], ["v"], mark)
    return run


def prepared(spark, kind):
    if kind == "changes":
        staging = new_name("staging")
        tables.save_table(items(spark, 0, 1).withColumns({"operation_type": F.lit("INSERT"), "processed_at": ts("1990-01-01")}), staging)
        return changes(staging), staging
    if kind == "stream":
        feed, mark = new_path(spark, "feed"), new_path(spark, "mark")
        for add in (200, 300):
            items(spark, 20, 34, add).coalesce(1).write.mode("append").parquet(feed)
        return a_stream(feed, mark), None
    return {"upsert": an_upsert, "delete": a_delete, "compact": a_compaction}[kind], None


@pytest.mark.parametrize("kind", ["upsert", "delete", "compact", "changes", "stream"])
def test_a_change_broken_off_anywhere_is_completed_by_its_rerun(spark, kind):
    work, staging = prepared(spark, kind)
    table = fresh(spark)
    work(spark, table)
    want, noted = rows(spark.table(table)), staging and rows(spark.table(staging))
    kept = {r[0] for r in want}
    for after in range(100):
        work, staging = prepared(spark, kind)
        table = fresh(spark)
        try:
            with tables.interrupted(after):
                work(spark, table)
            broken = False
        except Exception:  # a stream wraps what happens in it
            broken = True
        spark.catalog.refreshTable(table)
        there = [r[0] for r in spark.table(table).collect()]
        assert kept & set(range(30)) <= set(there)  # nothing that stays is ever absent
        work(spark, table)
        assert rows(spark.table(table)) == want, after
        if staging:
            assert rows(spark.table(staging)) == noted, after
        assert not subfolders(spark, f"{tables.location(spark, table)}/{tables.PENDING}")
        if not broken:
            break
    assert 2 <= after < 100


def test_reader_settles_and_an_undecided_swap_is_none(spark):
    table = fresh(spark)
    with pytest.raises(tables.Interrupted), tables.interrupted(2):
        an_upsert(spark, table)
    clean = fresh(spark)
    an_upsert(spark, clean)
    undecided = f"{tables.location(spark, table)}/{tables.PENDING}/0"
    spark.range(3).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(undecided)
    assert rows(tables.rows_of(spark, table)) == rows(spark.table(clean))
    assert tables.settle(spark, table) == 0 and exists(spark, undecided)


def test_emptied_partitions_take_rows_of_their_own_again(spark):
    table = fresh(spark)
    tables.delete_from(spark, table, F.lit(True))
    assert spark.table(table).count() == 0
    tables.append(items(spark, 0, 1), table)
    assert [r["part"] for r in spark.table(table).collect()] == ["n'0"]


def test_whole_table_swap_fails_cleanly(spark):
    table = new_name("t")
    tables.save_table(items(spark, 0, 10), table)
    with pytest.raises(tables.Interrupted), tables.interrupted(0):
        tables.upsert_table(items(spark, 5, 12, 1), table, ["id"], ["v"])
    assert rows(spark.table(table)) == rows(items(spark, 0, 10))
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("incoming")]


def contents(spark, table):
    """Path and identifiers of every current file, by the table's own scan and the files' footers."""
    files = {r[0].removeprefix("file://") for r in spark.table(table).select("_metadata.file_path").distinct().collect()}
    return {f: (pq.read_metadata(f).num_rows, pq.read_table(f, columns=["id"])["id"].to_pylist()) for f in files}


def test_upsert_of_one_key_rewrites_one_of_many_files(spark):
    table = new_name("t")
    tables.save_segmented(items(spark, 0, 1000), table, Layout(sort=("id",), files=10))
    before = contents(spark, table)
    assert len(before) == 10 and all(ids == sorted(ids) for _, ids in before.values())
    tables.upsert_table(items(spark, 555, 556, 500), table, ["id"], ["v"])
    after = contents(spark, table)
    assert len(after) == 10 and len(before.keys() & after.keys()) == 9
    assert all(before[f] == after[f] for f in before.keys() & after.keys())
    (new,) = after.keys() - before.keys()
    assert 555 in after[new][1]
    want = items(spark, 0, 1000).where("id <> 555").unionByName(items(spark, 555, 556, 500))
    assert rows(tables.rows_of(spark, table)) == rows(want)


def test_new_keys_and_appends_become_segments_and_resegment_joins_them(spark):
    table = new_name("t")
    tables.save_segmented(items(spark, 0, 100), table, Layout(sort=("id",), files=4))
    before = contents(spark, table)
    for k in range(100, 103):
        tables.upsert_table(items(spark, k, k + 1), table, ["id"], ["v"])
    tables.append(items(spark, 103, 110), table)
    assert before.keys() < contents(spark, table).keys()
    assert rows(tables.rows_of(spark, table)) == rows(items(spark, 0, 110))
    tables.delete_from(spark, table, F.col("id") < 10)
    tables.resegment(spark, table, Layout(sort=("id",), files=2))
    assert rows(tables.rows_of(spark, table)) == rows(items(spark, 10, 110))
    assert len(contents(spark, table)) == 2


def test_segments_take_changes_and_null_keys(spark):
    table, staging = new_name("t"), new_name("staging")
    nameless = items(spark, 0, 2).withColumn("id", F.lit(None).cast("bigint"))
    tables.save_segmented(items(spark, 0, 30).unionByName(nameless), table, Layout(sort=("id",), files=3))
    tables.save_table(items(spark, 0, 1).withColumns({"operation_type": F.lit("INSERT"), "processed_at": ts("1990-01-01")}), staging)
    source = items(spark, 3, 33, 1)
    for _ in range(2):
        procedures.load_changes(source, table, staging, ["id"], ["v"], ["v"], NOW, detect_deletes=True)
        assert rows(tables.rows_of(spark, table).where("id IS NOT NULL")) == rows(source)
    tables.upsert_table(nameless, table, ["id"], ["v"])
    assert tables.rows_of(spark, table).where("id IS NULL").count() == 4


def test_segmented_table_has_no_partitions_of_its_own(spark):
    with pytest.raises(ValueError):
        tables.save_segmented(items(spark, 0, 1), new_name("t"), Layout(partition_by=("part",)))
