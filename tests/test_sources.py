from __future__ import annotations

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import SparkSession, functions as F

from sparkwh import session
from sparkwh.functions import scalars
from sparkwh.operators import filters, querylog, reports
from sparkwh.plans import fixtures as fx
from sparkwh.plans.queries import REGISTRY, REPORTED
from sparkwh.session import new_name, new_path
from sparkwh.sources import eventlog, files, footers, synthetic
from sparkwh.streaming import loads as streams
from sparkwh.plans import tables

from .conftest import SF, rows


def test_delimited_keeps_declared_types(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1|x|2.50\n2||\n")
    got = files.read_delimited(spark, str(tmp_path), "id BIGINT, s STRING, m DECIMAL(10,2)", sep="|")
    assert [tuple(map(str, r)) for r in got.orderBy("id").collect()] == [("1", "x", "2.50"), ("2", "None", "None")]


def test_partitioned_scan_prunes_and_keeps_types(spark, plan_of):
    path = new_path(spark, "parts")
    fx.sales_by_month(spark, SF).write.partitionBy("sale_date", "region").csv(path)
    df = files.read_partitioned(spark, path, fx.SALES_PART_SCHEMA)
    assert dict(df.dtypes)["sale_date"] == "date" and dict(df.dtypes)["region"] == "string"
    text = plan_of(df.where("sale_date = DATE '1998-01-01' AND region = 'West' AND category = 'Books'").select("sale_id"))
    assert "PartitionFilters: [isnotnull(sale_date" in text and "PushedFilters: [IsNotNull(category)" in text
    assert "ReadSchema: struct<sale_id:bigint,category:string>" in text


def test_register_one_partition_then_all(spark):
    base, table = new_path(spark, "base"), new_name("ext")
    spark.range(10).select("id", (F.col("id") % 2).cast("int").alias("p")).write.partitionBy("p").parquet(base)
    files.create_external_table(spark, table, "id BIGINT, p INT", "parquet", base, ("p",))
    assert spark.table(table).count() == 0
    for _ in range(2):
        files.register_partition(spark, table, {"p": "1"}, f"{base}/p=1")
    assert rows(spark.table(table).select("p").distinct()) == [(1,)]
    files.recover_partitions(spark, table)
    assert spark.table(table).count() == 10


def test_database(spark):
    name = new_name("db")
    files.create_database(spark, name, new_path(spark, "db"))
    files.create_database(spark, name, new_path(spark, "db"))
    assert spark.catalog.databaseExists(name)


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_extract_file_formats(spark, fmt):
    path = new_path(spark, fmt)
    spark.range(3).write.format(fmt).save(path)
    assert files.extract(spark, path, fmt=fmt, schema="id BIGINT").count() == 3
    assert files.extract(spark, f"file:{path}", fmt=fmt, schema="id BIGINT").count() == 3


def test_extract_rejects_other_sources(spark):
    for bad in ("ftp://host/x", "relative/path", "mailto:x"):
        with pytest.raises(ValueError, match="Unsupported source type"):
            files.extract(spark, bad)
    for none in (None, ""):
        with pytest.raises(ValueError, match="needs a source"):
            files.extract(spark, none)


def test_jdbc_options():
    got = files.jdbc_options("jdbc:db://h/x", "t", partition_column="id", lower=0, upper=100, partitions=8)
    assert got["numPartitions"] == "8" and got["partitionColumn"] == "id" and got["url"] == "jdbc:db://h/x"
    assert "partitionColumn" not in files.jdbc_options("jdbc:db://h/x", "t")
    with pytest.raises(ValueError):
        files.jdbc_options("jdbc:db://h/x", "t", partition_column="id")


def test_compression_report_equals_the_footers(spark):
    path = new_path(spark, "c")
    spark.range(1000).withColumn("s", F.lit("x")).repartition(3).write.option("compression", "gzip").parquet(path)
    got = {r["column_name"]: r for r in footers.compression_report(spark, {"t": (path, "*.parquet")}).collect()}
    found = [pq.read_metadata(f) for f in glob.glob(f"{path}/*.parquet")]
    size = sum(m.row_group(g).column(0).total_compressed_size for m in found for g in range(m.num_row_groups))
    assert got["id"]["compressed_bytes"] == size and got["id"]["files"] == 3 and got["id"]["value_count"] == 1000
    assert got["s"]["codec"] == "GZIP" and "DICTIONARY" in got["s"]["encodings"]


def test_compression_report_takes_tables_that_are_folders(spark):
    """The same counts whether a table is one file or a folder of files."""
    base = new_path(spark, "tables")
    for name in REPORTED:
        spark.read.parquet(f"{SF}/{name}.parquet").repartition(2).write.parquet(f"{base}/{name}.parquet")
    assert rows(REGISTRY["compression_counts"](spark, base)) == rows(REGISTRY["compression_counts"](spark, SF))


def test_synthetic_rows(spark):
    sales = synthetic.generate_sales(synthetic.row_ids(spark, 20_000), 3, "2024-01-01 00:00:00")
    share = {r["region"]: r["count"] / 20_000 for r in sales.groupBy("region").count().collect()}
    assert abs(share["West"] - .3) < .02 and abs(share["East"] - .3) < .02 and abs(share["Central"] - .4) < .02
    assert abs(sales.where("NOT is_active").count() / 20_000 - .1) < .02
    assert sales.where("sale_date > '2024-01-01' OR sale_date <= '2023-01-01'").count() == 0
    assert sales.select("sale_id").distinct().count() == 20_000
    assert rows(sales.limit(0).unionByName(sales)) == rows(sales.repartition(3))
    facts = synthetic.generate_facts(synthetic.row_ids(spark, 20_000), 3, "2024-01-01 00:00:00")
    assert facts.groupBy("category").count().where("abs(count - 5000) > 400").count() == 0
    huge = synthetic.generate_sales(spark.range(1 << 62, (1 << 62) + 3), 3, "2024-01-01 00:00:00")
    assert huge.count() == huge.where("store_id BETWEEN 0 AND 99").count() == 3


def test_event_log_becomes_a_query_log(spark, event_log_dir):
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", "reports")
    spark.sparkContext.setJobDescription("count the orders")
    spark.read.parquet(f"{SF}/orders.parquet").where("o_custkey > 3").groupBy("o_orderstatus").count().collect()
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)
    spark.sparkContext.setJobDescription(None)
    log = eventlog.load_query_log(spark, event_log_dir.as_uri())
    one = log.where("query = 'count the orders'").collect()
    assert len(one) == 1
    assert one[0]["rows"] >= 1000 and one[0]["total_time"] >= 0 and one[0]["service_class"] == "reports"
    assert one[0]["end_time"] >= one[0]["start_time"]
    shape = fx.query_log(spark, SF)
    assert set(shape.columns) <= set(log.columns)
    assert {c: t for c, t in log.dtypes if c in shape.columns} == dict(shape.dtypes)
    assert querylog.class_report(log, "2020-01-01 00:00:00", "1 HOUR").count() >= 1


def test_shared_folder_comes_from_the_session(spark):
    assert new_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert new_path(spark, "x") != new_path(spark, "x")


def test_no_local_folder_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn", "spark.app.id": "a"}.get(key, default)

    class Cluster:
        conf = Conf()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_base(Cluster())


def test_filters_at_their_bounds(spark):
    df = spark.sql("""SELECT CAST(t AS TIMESTAMP_NTZ) AS t FROM VALUES ('2024-01-01'), ('2024-01-31'),
                      ('2024-01-31 00:00:01'), ('2024-02-01'), (NULL) AS v(t)""")
    assert filters.between(df, "t", "2024-01-01", "2024-01-31").count() == 2
    assert filters.recent(df, "t", "2024-02-01", "1 DAY").count() == 2
    assert filters.window_open_closed(df, "t", "2024-01-01", "2024-02-01").count() == 3
    text = spark.createDataFrame([("2024-01-31",), ("2024-01-31 10:00:00",), ("x",), (None,)], "d STRING")
    assert filters.between_dates_as_text(text, "d", "2024-01-01", "2024-01-31").count() == 1
    assert filters.between_dates_as_text(text, "d", "2024-01-01", "2024-02-01", typed=True).count() == 1
    assert filters.any_like(text, "d", ["%10:%", "x"]).count() == 2


def test_scalars(spark):
    got = spark.range(1).select(
        scalars.int_ratio(F.lit(7), F.lit(2)).alias("a"), scalars.int_ratio(F.lit(7), F.lit(0)).alias("b"),
        scalars.parse_ts(F.lit("2024-01-31")).alias("c"), scalars.trunc_ts("hour", scalars.ts("2024-01-01 10:59:59")).alias("d"))
    row = got.first()
    assert (row["a"], row["b"], row["c"], row["d"].hour, row["d"].minute) == (3, None, None, 10, 0)
    assert dict(got.dtypes)["d"] == "timestamp_ntz"


def test_report_plans(spark, plan_of):
    top = REGISTRY["top_customers"](spark, SF)
    assert "TakeOrderedAndProject" in plan_of(top)
    newest = reports.latest_version(fx.table(spark, SF, "lineitem"), ["l_orderkey"], "l_shipdate", ["l_linenumber"])
    text = plan_of(newest)
    assert text.count("WindowGroupLimit") == 2 and text.count("Exchange") == 1
    marked = REGISTRY["inc_by_timestamp"](spark, SF)
    text = marked._jdf.queryExecution().explainString(
        marked.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "GreaterThanOrEqual(o_orderdate,ScalarSubquery" in text


def test_stream_append_processes_each_file_once(spark):
    source, target, mark = (new_path(spark, n) for n in ("in", "out", "mark"))
    schema = "id BIGINT"
    for step, expected in ((range(0, 5), 5), (range(5, 5), 5), (range(5, 9), 9)):
        if len(step):
            spark.range(step.start, step.stop).write.mode("append").parquet(source)
        streams.stream_append(streams.read_new_files(spark, source, schema), target, mark)
        assert spark.read.parquet(target).count() == expected


def test_stream_upsert_ignores_late_and_repeated_versions(spark):
    source, table = new_path(spark, "in"), new_name("t")
    schema = "k INT, v INT, s STRING"

    def run(mark, *data):
        spark.createDataFrame(list(data), schema).coalesce(1).write.mode("append").parquet(source)
        rows_in = streams.read_new_files(spark, source, schema, maxFilesPerTrigger="1")
        streams.stream_latest_upsert(rows_in, table, ["k"], "v", ["s"], ["s"], mark)
    tables.save_table(spark.createDataFrame([(1, 5, "base"), (2, 1, "base")], schema), table)
    mark = new_path(spark, "mark")
    run(mark, (1, 4, "late"), (2, 2, "a"), (2, 3, "b"), (3, 1, "new"))
    assert rows(spark.table(table)) == [(1, 5, "base"), (2, 3, "b"), (3, 1, "new")]
    run(mark, (1, 6, "later"))
    after = rows(spark.table(table))
    assert after == [(1, 6, "later"), (2, 3, "b"), (3, 1, "new")]
    # A lost checkpoint repeats every batch; nothing changes.
    run(new_path(spark, "mark"), (2, 0, "old"))
    assert rows(spark.table(table)) == after


def test_stream_upsert_breaks_ties_across_batches(spark):
    schema = "k INT, v INT, s STRING"
    for order in (("a", "b"), ("b", "a")):
        source, table, mark = new_path(spark, "in"), new_name("t"), new_path(spark, "mark")
        tables.save_table(spark.createDataFrame([], schema), table)
        for s in order:
            spark.createDataFrame([(1, 7, s)], schema).coalesce(1).write.mode("append").parquet(source)
            streams.stream_latest_upsert(streams.read_new_files(spark, source, schema), table, ["k"], "v", ["s"], ["s"], mark)
        assert rows(spark.table(table)) == [(1, 7, "b")]


def test_stream_dedup_loses_no_row(spark):
    source, table, mark = new_path(spark, "in"), new_name("t"), new_path(spark, "mark")
    schema = "k INT, at TIMESTAMP_NTZ"
    tables.save_table(spark.createDataFrame([], schema), table)

    def arrive(checkpoint, *pairs):
        text = ", ".join(f"({k}, TIMESTAMP_NTZ '2024-01-01 {at}:00')" for k, at in pairs)
        spark.sql(f"SELECT CAST(col1 AS INT) AS k, col2 AS at FROM VALUES {text}").coalesce(1).write.mode("append").parquet(source)
        streams.stream_dedup(streams.read_new_files(spark, source, schema, maxFilesPerTrigger="1"), table, ["k"], "at", checkpoint)
    for pairs in ([(1, "10:00")], [(1, "10:02"), (3, "12:00"), (3, "12:00")], [(1, "11:00")], [(1, "11:30")], [(2, "09:00"), (1, "09:00")]):
        arrive(mark, *pairs)
    kept = [(1, "09:00"), (1, "10:00"), (1, "11:00"), (1, "11:30"), (2, "09:00"), (3, "12:00")]
    seen = lambda: sorted((r["k"], r["at"].strftime("%H:%M")) for r in spark.table(table).collect())
    assert seen() == kept
    arrive(new_path(spark, "mark"), (2, "09:01"))  # a lost checkpoint repeats every batch
    assert seen() == kept


def test_builder_settings():
    assert session.SETTINGS["spark.sql.adaptive.enabled"] == "true"
    assert isinstance(session.builder("x"), SparkSession.Builder)
    sized = session.builder("x", data_bytes=100 << 40)
    assert sized._options["spark.sql.shuffle.partitions"] == str((100 << 40) // session.TASK_BYTES)
    sized._options.pop("spark.sql.shuffle.partitions")
