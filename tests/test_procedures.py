"""The procedures on catalog tables, each run twice: the second run must add nothing."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sparkwh.functions.scalars import ts
from sparkwh.plans import fixtures as fx
from sparkwh.plans import procedures, tables
from sparkwh.plans.layout import Layout
from sparkwh.session import new_name

from .conftest import SF, rows

NOW = "2001-09-01 00:00:00"
COLS = ["customer_id", "order_date", "total_amount", "status"]


@pytest.fixture
def source(spark):
    return fx.src_orders(spark, SF)


@pytest.fixture
def target(spark, source):
    """Early orders only, without a creation time, with a load time."""
    table = new_name("orders")
    early = source.where("order_date < '1998-01-01'").drop("created_at").withColumn("loaded_at", ts("1998-01-01"))
    tables.save_table(early, table)
    return table


def check_complete(spark, source, table):
    assert rows(spark.table(table).select("order_id", *COLS)) == rows(source.select("order_id", *COLS))


def test_by_timestamp(spark, source, target):
    for _ in range(2):
        procedures.load_by_timestamp(source, target, "order_date", NOW)
        check_complete(spark, source, target)
    loaded = spark.table(target).groupBy("loaded_at").count().collect()
    assert len(loaded) == 2 and spark.table(target).where("loaded_at IS NULL").count() == 0


def test_by_id(spark, source):
    table = new_name("orders")
    tables.save_table(source.where("order_id < 700").withColumn("loaded_at", ts("1998-01-01")), table)
    for _ in range(2):
        procedures.load_by_id(source, table, "order_id", NOW)
        check_complete(spark, source, table)


def test_in_batches(spark, source):
    table = new_name("orders")
    tables.save_table(source.limit(0), table)
    log = procedures.load_in_batches(source, table, "order_id", NOW, batch_size=400)
    check_complete(spark, source, table)
    noted = {r["task"]: r["rows"] for r in spark.read.parquet(log).collect()}
    assert noted["batch_0"] == 400 and sum(noted.values()) == source.count()
    procedures.load_in_batches(source, table, "order_id", NOW, batch_size=400)
    check_complete(spark, source, table)


def test_delta(spark):
    table = new_name("feed")
    feed = fx.table(spark, SF, "events").select("user_id", "ts", "event_id")
    tables.save_table(feed.limit(0), table)
    for _ in range(2):
        procedures.load_delta(feed, table, ["user_id"], "ts", fx.EVENTS_NOW, ["event_id"], window="20 DAYS")
        recent = feed.where("ts > TIMESTAMP_NTZ '2024-01-31' - INTERVAL 20 DAYS")
        assert spark.table(table).count() == recent.select("user_id").distinct().count()


@pytest.mark.parametrize("partitioned", [False, True])
def test_changes(spark, partitioned):
    source, target = fx.src_orders(spark, SF).where("order_id % 15 <> 4"), fx.tgt_orders(spark, SF)
    layout = Layout(partition_by=("order_year",)) if partitioned else Layout()
    if partitioned:
        source, target = (d.withColumn("order_year", F.year("order_date")) for d in (source, target))
    table, staging = new_name("orders"), new_name("staging")
    tables.save_table(target.drop("created_at").withColumn("loaded_at", ts("1998-01-01"))
                      .select(*[c for c in target.columns if c not in ("created_at", "order_year")], "loaded_at",
                              *(["order_year"] if partitioned else [])), table, layout)
    old = source.drop("created_at").withColumns({"operation_type": F.lit("INSERT"), "processed_at": ts("1990-01-01")})
    tables.save_table(old.limit(5), staging)
    options = dict(detect_deletes=True, layout=layout)
    procedures.load_changes(source, table, staging, ["order_id"], ["status", "total_amount"], COLS, NOW, **options)
    check_complete(spark, source, table)
    noted = {r["operation_type"]: r["count"] for r in spark.table(staging).groupBy("operation_type").count().collect()}
    assert noted["INSERT"] == source.where("order_id % 10 = 0").count()
    assert noted["DELETE"] == target.where("order_id % 15 = 4").count()
    before = spark.table(staging).count()
    procedures.load_changes(source, table, staging, ["order_id"], ["status", "total_amount"], COLS, NOW, **options)
    check_complete(spark, source, table)
    assert spark.table(staging).count() == before


def test_maintenance(spark):
    sales, facts = new_name("sales"), new_name("facts")

    def fresh():
        for name, df in ((sales, fx.sales(spark, SF)), (facts, fx.facts(spark, SF))):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
            tables.save_table(df, name)
        return {sales: ~F.col("is_active"), facts: F.col("metric_value") < 100}
    gone = fresh()
    procedures.maintain(spark, gone, {sales: Layout(sort=("sale_date", "region"))}, {facts: ["metric_value"]})
    assert spark.table(sales).where(~F.col("is_active")).count() == 0
    assert spark.table(facts).where("metric_value < 100").count() == 0
    stats = spark.sql(f"DESCRIBE FORMATTED {facts}").where("col_name = 'Statistics'").first()["data_type"]
    assert f"{spark.table(facts).count()} rows" in stats
    gone = fresh()
    by_count = {r["table_name"]: r["compacted"] for r in procedures.maintain_by_count(spark, gone, min_deleted=160).collect()}
    assert by_count == {sales: False, facts: True}
    gone = fresh()
    by_share = {r["table_name"]: r["compacted"] for r in procedures.maintain_by_share(spark, gone, share=0.09).collect()}
    assert by_share == {sales: True, facts: True}
