from __future__ import annotations

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from sparkwh.functions.scalars import ts
from sparkwh.operators import joins, loads
from sparkwh.operators.upkeep import analyze_table, column_statistics, key_skew, zone_overlap, zone_ranges
from sparkwh.plans import fixtures as fx
from sparkwh.plans import jobs, layout, tables, upkeep
from sparkwh.plans.layout import ENCODING_NAMES, Layout, arrange, write_files
from sparkwh.session import new_name, new_path, stage
from sparkwh.sources import footers

from .conftest import SF, rows


def numbers(spark, n=1000):
    k = F.col("id")
    return spark.range(n).select(k, (k % 10).cast("int").alias("part"), (k % 97).cast("int").alias("v"),
                                 F.concat(F.lit("name_"), k % 13).alias("name"))


def data_files(spark, table):
    base = tables.location(spark, table).removeprefix("file:")
    return sorted(f for f in glob.glob(f"{base}/**/*.parquet", recursive=True))


def test_append_goes_by_name_and_needs_all_columns(spark):
    table = new_name("t")
    tables.save_table(numbers(spark, 5), table)
    tables.append(numbers(spark, 5).select("name", "v", "part", "id"), table)
    assert spark.table(table).where("id = 3").select("name", "v").distinct().collect()[0][0] == "name_3"
    with pytest.raises(ValueError, match="lack"):
        tables.append(numbers(spark, 5).drop("v"), table)


def test_publish_keeps_the_old_folder_and_open_readers(spark):
    table = new_name("t")
    tables.save_table(numbers(spark, 10), table)
    before = spark.table(table)
    assert before.count() == 10
    old = tables.publish(spark.table(table).where("id < 3"), table)
    assert spark.table(table).count() == 3
    assert spark.read.parquet(old).count() == 10
    assert tables.location(spark, table) != old


def test_publish_keeps_buckets(spark, plan_of, no_broadcast):
    layout = Layout(dist="key", key="id", buckets=4)
    left, right = new_name("l"), new_name("r")
    for t in (left, right):
        tables.save_table(numbers(spark), t, layout)
    tables.publish(spark.table(left).where("id % 2 = 0"), left, layout)
    joined = spark.table(left).join(spark.table(right), "id")
    assert "Exchange" not in plan_of(joined)
    assert joined.count() == 500


def test_upsert_touches_only_its_partitions(spark):
    layout = Layout(partition_by=("part",))
    table = new_name("t")
    tables.save_table(numbers(spark), table, layout)

    def others():
        return rows(spark.table(table).where("part NOT IN (3, 4)").select("_metadata.file_path").distinct())
    before = others()
    batch = numbers(spark, 1100).where("part IN (3, 4)").withColumn("v", F.lit(-1))
    tables.upsert_table(batch, table, ["id"], ["v", "name"], layout=layout)
    got = spark.table(table)
    assert got.count() == 1000 + 20 and got.where("v = -1").count() == 220
    assert others() == before


def test_upsert_new_partition_becomes_visible(spark):
    layout = Layout(partition_by=("part",))
    table = new_name("t")
    tables.save_table(numbers(spark, 20), table, layout)
    tables.upsert_table(numbers(spark, 3).withColumn("part", F.lit(77)).withColumn("id", F.col("id") + 500), table,
                        ["id"], ["v"], layout=layout)
    assert spark.table(table).where("part = 77").count() == 3 and spark.table(table).count() == 23


def test_delete_empties_a_partition(spark):
    layout = Layout(partition_by=("part",))
    table = new_name("t")
    tables.save_table(numbers(spark), table, layout)
    tables.delete_from(spark, table, (F.col("part") == 2) | (F.col("id") == 1), layout)
    got = spark.table(table)
    assert got.count() == 899 and got.where("part = 2").count() == 0
    tables.append(numbers(spark, 3).withColumn("part", F.lit(2)).select("id", "v", "name", "part"), table)
    assert spark.table(table).where("part = 2").count() == 3
    tables.upsert_table(numbers(spark).where("part = 2"), table, ["id"], ["v"], layout=layout)
    # The batch holds 100 rows, one of which (id 2) was appended above.
    assert spark.table(table).where("part = 2").count() == 102


def test_partition_values_of_every_kind(spark):
    layout = Layout(partition_by=("p", "q"))
    data = [(1, "a b", 1), (2, "it's", 2), (3, "x/y=z%", 3), (4, None, None), (5, "ü\\", 5)]
    df = spark.createDataFrame(data, "id INT, p STRING, q INT")
    table = new_name("t")
    tables.save_table(df, table, layout)
    changed = df.withColumn("id", F.col("id") + 10)
    tables.overwrite_partitions(changed, table)
    assert rows(spark.table(table).select("id", "p", "q")) == rows(changed)
    tables.delete_from(spark, table, F.col("id") % 2 == 1, layout)
    assert rows(spark.table(table).select("id")) == [(12,), (14,)]
    many = tables.in_partitions(spark.range(300).select((F.col("id") % 20).cast("string").alias("p"),
                                                        F.floor(F.col("id") / 20).alias("q")), ["p", "q"])
    assert spark.table(table).where(many).count() == 0



def test_partition_predicate_prunes(spark, plan_of):
    table = new_name("t")
    tables.save_table(numbers(spark), table, Layout(partition_by=("part",)))
    chosen = spark.table(table).where(tables.in_partitions(numbers(spark).where("part IN (1, 2)"), ["part"]))
    assert "PartitionFilters: [part" in plan_of(chosen)
    assert spark.table(table).where(tables.in_partitions(numbers(spark, 0), ["part"])).count() == 0


def test_small_batch_does_not_shuffle_the_target(spark, plan_of, no_broadcast):
    table = new_name("t")
    tables.save_table(numbers(spark), table)
    text = plan_of(loads.update_from(spark.table(table), numbers(spark, 5), ["id"], ["v"], small=True, check=False))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text
    found = joins.matching_keys(spark.table(table), numbers(spark, 5), ["id"], small=True)
    text = plan_of(found)
    assert "LeftSemi" in text and "BroadcastHashJoin" in text and "ReadSchema: struct<id:bigint>" in text


def test_colocated_join_with_a_hot_key(spark, plan_of, no_broadcast):
    k = F.col("id")
    facts = spark.range(3000).select(F.when(k % 3 == 0, 5).when(k % 11 == 0, None).otherwise(k % 40).alias("key"),
                                     k.alias("n"))
    dims = spark.range(30).select(k.alias("key"), F.concat(F.lit("d"), k).alias("d"))
    layout = Layout(dist="key", key="key", buckets=4)
    left, right = new_name("l"), new_name("r")
    tables.save_table(facts, left, layout), tables.save_table(dims, right, layout)
    assert joins.hot_keys(spark.table(left), "key", 0.2) == [5]
    for how in ("inner", "left"):
        got = joins.colocated_join(spark, left, right, "key", how, hot_share=0.2)
        assert rows(got.select("key", "n", "d")) == rows(facts.join(dims, "key", how).select("key", "n", "d"))
        assert "explode" in plan_of(got)
    plain = joins.colocated_join(spark, left, right, "key", hot_share=0.9)
    assert "Exchange" not in plan_of(plain)
    with pytest.raises(ValueError):
        joins.colocated_join(spark, left, right, "key", "full")


def test_colocated_join_with_keys_hot_on_either_side(spark):
    k = F.col("id")
    left_rows = spark.range(900).select(F.when(k % 3 == 0, 1).when(k % 3 == 1, 2).otherwise(k).alias("key"), k.alias("n"))
    right_rows = spark.range(60).select(F.when(k % 2 == 0, 3).when(k % 5 == 0, 1).otherwise(k).alias("key"), k.alias("d"))
    layout = Layout(dist="key", key="key", buckets=3)
    left, right = new_name("l"), new_name("r")
    tables.save_table(left_rows, left, layout), tables.save_table(right_rows, right, layout)
    for how in ("inner", "left"):
        got = joins.colocated_join(spark, left, right, "key", how, hot_share=0.08, salts=6)
        assert rows(got.select("key", "n", "d")) == rows(left_rows.join(right_rows, "key", how).select("key", "n", "d"))


def test_writes_follow_the_stored_layout(spark):
    """No write needs to be told the partitions or buckets; a layout that contradicts them is refused before writing."""
    table = new_name("t")
    tables.save_table(numbers(spark), table, Layout(partition_by=("part",)))
    total = spark.table(table).count()
    tables.delete_from(spark, table, F.col("id") < 10)
    assert spark.table(table).count() == total - 10
    tables.publish(spark.table(table).where("part <> 1"), table)
    assert spark.table(table).where("part = 1").count() == 0
    before = spark.table(table).count()
    with pytest.raises(ValueError):
        tables.publish(spark.table(table), table, Layout(partition_by=("v",)))
    with pytest.raises(ValueError):
        tables.publish(spark.table(table), table, Layout(dist="key", key="id", buckets=2))
    assert spark.table(table).count() == before
    bucketed = new_name("b")
    tables.save_table(numbers(spark), bucketed, Layout(dist="key", key="id", buckets=3))
    tables.delete_from(spark, bucketed, F.col("id") < 10)
    assert spark.table(bucketed).count() == total - 10 and tables.stored_layout(spark, bucketed).buckets == 3
    with pytest.raises(ValueError):
        tables.publish(spark.table(bucketed), bucketed, Layout(interleave=("id",)))


def test_untouched_partitions_are_not_rewritten(spark):
    table = new_name("t")
    tables.save_table(numbers(spark), table, Layout(partition_by=("part",)))
    files = lambda: {r[0]: r[1] for r in spark.table(table).groupBy("part").agg(F.min("_metadata.file_path")).collect()}
    first = files()
    batch = spark.table(table).where("part = 2").limit(1).withColumn("part", F.lit(3))
    tables.upsert_table(batch, table, ["id"], ["v"])
    changed = {p for p, path in files().items() if path != first[p]}
    assert changed == {2, 3} and spark.table(table).count() == numbers(spark).count()


def test_partitioned_compaction_keeps_the_order_and_the_file_size(spark):
    table = new_name("t")
    tables.save_table(numbers(spark).repartition(12), table, Layout(partition_by=("part",)))
    upkeep.compact(spark, table, Layout(interleave=("id", "v")))
    per = spark.table(table).groupBy("part").agg(F.count_distinct("_metadata.file_path").alias("files")).collect()
    assert all(r["files"] == 1 for r in per) and spark.table(table).count() == numbers(spark).count()


def test_files_follow_the_size_of_the_data(spark):
    path, small = new_path(spark, "many"), new_path(spark, "few")
    spark.range(200_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("pad")).write.parquet(path)
    spark.range(20_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("pad")).write.parquet(small)
    many, few = (layout.pieces_of(spark.read.parquet(p), 100_000) for p in (path, small))
    assert 8 <= many / few <= 12
    assert layout.pieces_of(spark.read.parquet(path).join(spark.read.parquet(small), "id"), 100_000) <= many + few + 1


@pytest.mark.parametrize("shape", [Layout(sort=("id",)), Layout(interleave=("id", "v")), Layout(dist="even"),
                                   Layout(sort=("id",), partition_by=("part",)), "segments", "compact", "compact_parted"])
def test_no_task_deals_more_rows_than_it_can_sort(spark, monkeypatch, shape):
    """Rows that compress to next to nothing still get as many tasks as they need in memory."""
    path, table = new_path(spark, "wide"), new_name("t")
    numbers(spark, 4000).withColumns({"part": F.col("id") % 2, "pad": F.repeat(F.lit("x"), 1000)}).write.option("compression", "zstd").parquet(path)
    df = spark.read.parquet(path)
    monkeypatch.setattr(layout, "ROW_BYTES", 500_000, raising=False)
    if shape == "segments":
        tables.save_segmented(df, table, Layout(sort=("id",)))
    elif isinstance(shape, str):
        parts = ("part",) if shape == "compact_parted" else ()
        tables.save_table(df.coalesce(1), table, Layout(partition_by=parts))
        upkeep.compact(spark, table, Layout(sort=("id",)))
    else:
        tables.save_table(df, table, shape)
    per_file = spark.table(table).groupBy("_metadata.file_path").count().agg(F.max("count"), F.sum("count")).first()
    assert per_file[0] <= 800 and per_file[1] == 4000


def test_bytes_of_rows_count_what_is_nested(spark):
    one = spark.sql("""SELECT 1 AS i, 'abc' AS s, CAST(NULL AS STRING) AS n, array(1, 2) AS a, array('ab', 'c') AS t,
        map('k', 'vw') AS m, named_struct('x', 'yz', 'w', 2) AS r, CAST(1 AS DECIMAL(38, 0)) AS d""")
    # 8 columns and a head of 8 bytes each; 3 + 0 + 2 * 8 + (2 * 8 + 3) + (8 + 1 + 8 + 2) + (2 * 8 + 2) + 16 beyond
    assert layout.row_bytes(one) == 9 * 8 + 3 + 16 + 19 + 19 + 18 + 16
    assert layout.row_bytes(one.where("i > 1")) == 0 and layout.files_of(one.where("i > 1")) == 1


def test_one_file_layout_obeys_or_refuses(spark, monkeypatch):
    path = new_path(spark, "one")
    spark.range(1000).write.parquet(path)
    write_files(spark.read.parquet(path), path + "-all", Layout(dist="all"))
    assert spark.read.parquet(path + "-all").select("_metadata.file_path").distinct().count() == 1
    monkeypatch.setattr(layout, "ALL_BYTES", 10)
    with pytest.raises(ValueError):
        write_files(spark.read.parquet(path), path + "-more", Layout(dist="all"))


def test_hot_key_is_split_over_files_of_its_bucket(spark):
    """Writing by key does not put a third of the rows through one task once they exceed a task's size."""
    held = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        k = F.col("id")
        df = spark.range(120_000).repartition(12).select(F.when(k % 3 == 0, 1).otherwise(k).alias("key"),
                                                         F.sha2(k.cast("string"), 256).alias("pad"))
        table = new_name("t")
        tables.save_table(df, table, Layout(dist="key", key="key", buckets=4))
        per_file = spark.table(table).where("key = 1").groupBy("_metadata.file_path").count()
        assert per_file.count() > 1 and per_file.agg(F.sum("count")).first()[0] == 40_000 + 1
        both = spark.table(table).groupBy("key").count().agg(F.sum("count")).first()[0]
        assert both == 120_000
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", held)


def test_dimension_is_broadcast_only_if_small(spark, plan_of, no_broadcast, monkeypatch):
    fact, dim = numbers(spark), numbers(spark, 50).select("id", F.lit("x").alias("d"))
    assert "BroadcastHashJoin" in plan_of(joins.broadcast_dim(fact, dim, ["id"], small=True))
    monkeypatch.setattr(joins, "SMALL_BYTES", 100)
    with pytest.raises(ValueError, match="not small"):
        joins.broadcast_dim(fact, dim, ["id"], small=True)
    large = joins.broadcast_dim(fact, dim, ["id"])
    assert "BroadcastHashJoin" not in plan_of(large) and large.count() == 50


def test_compound_sort_reaches_few_files(spark):
    path = new_path(spark, "sorted")
    df = spark.range(20_000).repartition(8).select("id", (ts("2024-01-01") + F.make_dt_interval(mins=F.col("id"))).alias("at"))
    write_files(df, path, Layout(sort=("at",), files=8))
    got = zone_overlap(zone_ranges(spark.read.parquet(path), "at"), ts("2024-01-02"), ts("2024-01-03")).first()
    assert got["file_count"] == 8 and got["files_hit"] <= 3 and got["row_count"] == 20_000


def test_footers_give_the_same_ranges(spark):
    path = new_path(spark, "zones")
    k = F.col("id")
    df = spark.range(5000).select(
        "id", (k / 7).alias("d"), (k / 100).cast("decimal(12,2)").alias("m"), F.concat(F.lit("n"), k).alias("s"),
        (ts("2024-01-01") + F.make_dt_interval(secs=k)).alias("t"), F.date_add(F.lit("2024-01-01"), (k % 90).cast("int")).alias("day"),
        F.when(k % 3 == 0, k).alias("some"), F.lit(None).cast("int").alias("none"))
    write_files(df, path, Layout(sort=("id",), files=6))
    back = spark.read.parquet(path)
    for column, data_type in df.dtypes:
        seen = footers.column_ranges(spark, path, column, data_type)
        assert seen.where("NOT known").count() == 0
        assert rows(seen.select("row_count", "min_value", "max_value")) == \
            rows(zone_ranges(back, column).select("row_count", "min_value", "max_value"))
    assert footers.column_ranges(spark, path, "absent", "int").where("known").count() == 0


def test_equal_sort_values_are_split(spark):
    df = spark.range(10_000).withColumn("same", F.lit(1))
    sizes = arrange(df, Layout(sort=("same",), files=8)).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 3000


def test_interleave_narrows_every_column(spark):
    path = new_path(spark, "inter")
    k = F.col("id")
    df = spark.range(40_000).repartition(8).select((k % 200).alias("a"), (F.floor(k / 200) % 200).alias("b"),
                                                   F.concat(F.lit("n"), F.lpad((k * 7 % 100).cast("string"), 3, "0")).alias("c"))
    write_files(df, path, Layout(interleave=("a", "b", "c"), bits=3, files=64))
    back = spark.read.parquet(path)
    assert set(back.columns) == {"a", "b", "c"} and back.count() == 40_000
    for column, value in (("a", F.lit(10)), ("b", F.lit(150)), ("c", F.lit("n042"))):
        got = zone_overlap(zone_ranges(back, column), value, value).first()
        assert got["files_hit"] <= 0.6 * got["file_count"]


def test_even_and_all(spark):
    table = new_name("t")
    tables.save_table(numbers(spark), table, Layout(dist="even", files=5))
    sizes = [pq.read_metadata(f).num_rows for f in data_files(spark, table)]
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= 8
    single = new_name("t")
    tables.save_table(numbers(spark).repartition(6), single, Layout(dist="all"))
    assert len(data_files(spark, single)) == 1


def test_encodings_and_codec(spark):
    table = new_name("t")
    tables.save_table(numbers(spark), table, Layout(encodings={"id": "delta", "name": "dict"}, codec="zstd"))
    meta = pq.read_metadata(data_files(spark, table)[0]).row_group(0)
    columns = {meta.column(i).path_in_schema: meta.column(i) for i in range(meta.num_columns)}
    assert "DELTA_BINARY_PACKED" in columns["id"].encodings
    assert "RLE_DICTIONARY" in columns["name"].encodings
    assert columns["id"].compression == "ZSTD"
    assert rows(spark.table(table)) == rows(numbers(spark))


def test_reencode_an_existing_table(spark):
    table = new_name("t")
    tables.save_table(numbers(spark), table, Layout(codec="snappy"))
    tables.publish(spark.table(table), table, Layout(encodings={"id": "delta"}, codec="gzip"))
    chunk = pq.read_metadata(data_files(spark, table)[0]).row_group(0).column(0)
    assert chunk.compression == "GZIP" and "DELTA_BINARY_PACKED" in chunk.encodings
    assert rows(spark.table(table)) == rows(numbers(spark))


def test_layout_rejects_nonsense():
    for bad in ({"dist": "odd"}, {"dist": "key"}, {"key": "a"}, {"sort": ("a",), "interleave": ("b",)},
                {"codec": "lzo"}, {"encodings": {"a": "huffman"}},
                {"dist": "key", "key": "a", "partition_by": ("b",)}):
        with pytest.raises(ValueError):
            Layout(**bad)
    assert set(ENCODING_NAMES.values()) == {"plain", "dict", "delta"}


def test_compact_merges_files_and_keeps_rows(spark):
    table = new_name("t")
    tables.save_table(numbers(spark), table, Layout(dist="even", files=20))
    upkeep.compact(spark, table, Layout(sort=("v",)), F.col("part") == 0)
    assert len(data_files(spark, table)) == 1
    assert rows(spark.table(table)) == rows(numbers(spark).where("part <> 0"))
    parted, layout = new_name("t"), Layout(partition_by=("part",))
    tables.save_table(numbers(spark).repartition(6), parted, layout)
    upkeep.compact(spark, parted, layout, F.col("part") == 0)
    assert rows(spark.table(parted).select("id", "part", "v", "name")) == rows(numbers(spark).where("part <> 0"))


def test_selective_compact_goes_on_after_a_failure(spark):
    some, none = new_name("t"), new_name("t")
    tables.save_table(numbers(spark), some)
    tables.save_table(numbers(spark, 0), none)
    report = upkeep.selective_compact(spark, {"absent_table": F.lit(True), none: F.col("part") == 0,
                                              some: F.col("part") == 0}, ratio=0.05)
    got = {r["table_name"]: r for r in report.collect()}
    assert got["absent_table"]["error"] and not got["absent_table"]["compacted"]
    assert not got[none]["compacted"] and got[none]["error"] is None
    assert (got[some]["deleted_before"], got[some]["deleted_after"], got[some]["total_after"]) == (100, 0, 900)


def test_statistics_and_histogram(spark):
    table = new_name("t")
    tables.save_table(numbers(spark), table)
    analyze_table(spark, table, ["id", "name"], bins=5)
    got = {r["column_name"]: r for r in column_statistics(spark, table, ["id", "name"]).collect()}
    assert (got["id"]["min_value"], got["id"]["max_value"], got["id"]["null_count"]) == ("0", "999", 0)
    assert abs(got["name"]["distinct_count"] - 13) <= 1
    assert spark.conf.get("spark.sql.statistics.histogram.enabled") == "false"


def test_key_skew_shows_the_hot_bucket(spark):
    df = spark.range(900).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"))
    top = key_skew(df, "k", 8).orderBy(F.col("skew").desc()).first()
    assert top["row_count"] >= 300 and top["skew"] > 2


def test_batches_resume_without_repeating(spark):
    table, log = new_name("t"), new_path(spark, "log")
    source = numbers(spark, 100)
    tables.save_table(source.limit(0), table)
    jobs.new_run_log(spark, log)
    batches = stage(loads.batch_assign(source, spark.table(table), "id", 30))
    # A first run wrote batch 0, and died after writing batch 1 but before noting it.
    tables.append(batches.where("batch_no <= 1"), table)
    jobs.log_step(spark, log, "load", "batch_0", "completed", "2024-01-01", "2024-01-01", 30)
    jobs.load_batches(batches, table, "id", log, "load", "2024-01-01 00:00:00")
    assert rows(spark.table(table)) == rows(source)
    noted = spark.read.parquet(log)
    assert {r["task"]: r["rows"] for r in noted.collect()} == {"batch_0": 30, "batch_1": 0, "batch_2": 30, "batch_3": 10}


def test_metrics_count_without_a_second_scan(spark):
    table = new_name("t")
    tables.save_table(numbers(spark, 0), table)
    got = jobs.load_with_metrics(numbers(spark, 42), table, "2024-01-01 00:00:00").first()
    assert got["records_loaded"] == 42 and got["target"] == table


def test_daily_load_of_a_table_is_logged_and_repeatable(spark):
    table, log, source = new_name("w"), new_path(spark, "log"), new_path(spark, "in")
    fx.sales(spark, SF).write.parquet(source)
    tables.save_table(fx.warehouse_sales(spark, SF), table)
    jobs.new_run_log(spark, log)
    for _ in range(2):
        jobs.daily_sales_load(spark, source, table, "2001-07-01 00:00:00", log)
        want = jobs.daily_sales_job(spark, source, fx.warehouse_sales(spark, SF), "2001-07-01 00:00:00")
        assert rows(spark.table(table)) == rows(want)
    noted = spark.read.parquet(log).where("status = 'completed'")
    assert noted.count() == 4 and {r["rows"] for r in noted.collect()} == {
        fx.sales(spark, SF).where("sale_date >= '2001-06-30'").count()}
    with pytest.raises(ValueError):
        jobs.daily_sales_load(spark, "ftp://x", table, "2001-07-01 00:00:00", log)
    failed = spark.read.parquet(log).where("status = 'failed'").collect()
    assert [(r["task"], r["error_message"]) for r in failed] == [("transform", "Unsupported source type: ftp://x")]


def test_run_summary(spark):
    log = new_path(spark, "log")
    jobs.new_run_log(spark, log)
    jobs.log_step(spark, log, "a", "x", "completed", "2024-01-01 10:00:00", "2024-01-01 10:00:30", 5)
    jobs.log_step(spark, log, "a", "y", "completed", "2024-01-01 10:00:30", "2024-01-01 10:02:00", 7)
    jobs.log_step(spark, log, "b", "x", "failed", "2024-01-01 10:00:00", "2024-01-01 10:00:30", error="no", retries=2)
    jobs.log_step(spark, log, "c", "x", "running", "2024-01-01 10:00:00", None)
    got = {r["pipeline_name"]: r for r in jobs.run_summary(spark.read.parquet(log)).collect()}
    assert (got["a"]["status"], got["a"]["duration_seconds"], got["a"]["rows"]) == ("completed", 120, 12)
    assert (got["b"]["status"], got["b"]["failed_tasks"]) == ("failed", 1)
    assert (got["c"]["status"], got["c"]["duration_seconds"]) == ("running", None)
    with pytest.raises(ValueError):
        jobs.sql_transform(spark, "")
