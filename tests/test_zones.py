"""Files left out by the stored ranges of their columns."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sparkwh.operators.querylog import class_percentile
from sparkwh.plans.layout import Layout, write_files
from sparkwh.session import new_path
from sparkwh.sources import zones

from .conftest import rows


def table(spark, low=0, high=4000):
    k = F.col("id")
    return spark.range(low, high).select(
        k, (k % 50).cast("int").alias("store"), F.concat(F.lit("r"), k % 7).alias("region"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_interval(mins=k)).alias("at"),
        F.when(k % 3 > 0, (k / 4).cast("decimal(10,2)")).alias("amount"))


def opened(df) -> set[str]:
    return {r[0] for r in df.select("_metadata.file_path").distinct().collect()}


@pytest.mark.parametrize("layout", [Layout(sort=("at", "region"), files=12), Layout(interleave=("store", "region", "amount"), files=12)])
def test_scan_opens_only_files_that_meet_all_ranges(spark, layout):
    path = new_path(spark, "zoned")
    write_files(table(spark), path, layout)
    low, high = dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 2, 5)
    ranges = ({"at": (F.lit(low).cast("timestamp_ntz"), F.lit(high).cast("timestamp_ntz")), "region": (F.lit("r3"), None)} if layout.sort
              else {"store": (F.lit(7), F.lit(9)), "region": (F.lit("r2"), F.lit("r3")), "amount": (None, F.lit(900))})
    got = zones.scan_zones(spark, path, ranges)
    whole = spark.read.parquet(path)
    want = (whole.where(F.col("at").between(low, high) & (F.col("region") >= "r3")) if layout.sort
            else whole.where("store BETWEEN 7 AND 9 AND region BETWEEN 'r2' AND 'r3' AND amount <= 900"))
    assert rows(got) == rows(want) and want.count() > 0
    holding = opened(want)
    chosen = set(zones.files_meeting(spark, path, ranges))
    assert len(holding) <= len(chosen) < 12 and len(got.inputFiles()) == len(chosen)
    assert whole.count() == 4000  # the index is no data


def test_files_without_zones_are_opened_until_noted(spark):
    path = new_path(spark, "zoned")
    write_files(table(spark), path, Layout(sort=("at",), files=6))
    table(spark, 9000, 9010).coalesce(1).write.mode("append").parquet(path)
    ask = {"id": (F.lit(9003), F.lit(9004)), "at": (F.lit("2024-01-07 00:00:00").cast("timestamp_ntz"), None)}
    assert len(zones.files_meeting(spark, path, ask)) == 1
    late = {"at": (None, F.lit("2024-01-01 01:00:00").cast("timestamp_ntz"))}
    assert len(zones.files_meeting(spark, path, late)) == 2
    zones.note_zones(spark, path, ["at"])
    zones.note_zones(spark, path, ["at"])
    assert len(zones.files_meeting(spark, path, late)) == 1
    assert zones.stored_zones(spark, path).count() == 7
    assert rows(zones.scan_zones(spark, path, ask).select("id")) == [(9003,), (9004,)]


def test_nulls_and_nothing_to_open(spark):
    path = new_path(spark, "zoned")
    write_files(table(spark).withColumn("amount", F.lit(None).cast("int")), path, Layout(sort=("amount", "id"), files=3))
    assert zones.files_meeting(spark, path, {"amount": (F.lit(1), F.lit(2))}) == []
    empty = zones.scan_zones(spark, path, {"amount": (F.lit(1), F.lit(2))})
    assert empty.count() == 0 and empty.columns == spark.read.parquet(path).columns
    assert zones.scan_zones(spark, path, {}).count() == 4000


@pytest.mark.parametrize("p", [0.0, 0.5, 0.95, 1.0])
def test_percentile_of_a_hot_group_equals_the_sorted_values(spark, plan_of, p):
    k = F.col("id")
    log = spark.range(60_000).select(
        F.lit("2024-01-01 00:30:00").cast("timestamp_ntz").alias("start_time"),
        F.when(k % 10 < 6, "hot").when(k % 10 < 8, F.lit(None)).otherwise(F.concat(F.lit("c"), k % 997)).alias("service_class"),
        F.when(k % 13 > 0, (F.xxhash64("id") % 100_000).cast("bigint")).alias("total_time"))
    got = {r["service_class"]: r for r in class_percentile(log, "hour", p, "2024-01-01 01:00:00", "2 HOURS").collect()}
    values = {}
    for r in log.collect():
        values.setdefault(r["service_class"], []).append(r["total_time"])
    assert got.keys() == values.keys()
    for name, all_ in values.items():
        known = sorted(v for v in all_ if v is not None)
        at = p * (len(known) - 1)
        want = known[int(at)] + (at - int(at)) * (known[min(int(at) + 1, len(known) - 1)] - known[int(at)])
        assert got[name]["query_count"] == len(all_) and abs(got[name][f"p{round(p * 100)}_execution_time"] - want) < 1e-6
