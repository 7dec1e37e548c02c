from __future__ import annotations

import statistics

import numpy as np
from pyspark.sql import functions as F

from sparkwh.functions import numbering
from sparkwh.operators.profiles import approximate_profile, column_profile, encoding_profile, most_common_values
from sparkwh.operators.querylog import class_percentile

from .conftest import rows


def skewed(spark, n=3000):
    """A third of the rows share one value; some are NULL."""
    k = F.col("id")
    return spark.range(n).repartition(7).select(
        k.alias("id"), F.when(k % 3 == 0, 7).when(k % 50 == 1, None).otherwise((k * 37) % 101).cast("int").alias("v"))


def test_position_is_dense_and_in_order(spark):
    got = numbering.with_position(skewed(spark), [F.col("v").asc_nulls_first(), "id"]).collect()
    want = sorted(((-1 if r["v"] is None else r["v"], r["id"]) for r in got))
    by_place = sorted(got, key=lambda r: r["position"])
    assert [r["position"] for r in by_place] == list(range(3000))
    assert [(-1 if r["v"] is None else r["v"], r["id"]) for r in by_place] == want


def test_position_of_nothing(spark):
    assert numbering.with_position(skewed(spark).limit(0), ["id"]).count() == 0


def test_identity_start_and_step(spark):
    got = numbering.assign_identity(spark.range(5), [F.col("id").desc()], start=100, step=-10)
    assert rows(got) == [(0, 60), (1, 70), (2, 80), (3, 90), (4, 100)]


def test_running_total(spark):
    got = numbering.with_running_total(spark.range(500).withColumn("w", F.col("id") % 5), ["id"], "w").collect()
    before = 0
    for r in sorted(got, key=lambda r: r["id"]):
        assert r["before"] == before
        before += r["w"]


def test_previous_crosses_partitions(spark):
    got = numbering.with_previous(skewed(spark), ["id"], ["id", "v"]).collect()
    by_id = {r["id"]: r for r in got}
    assert by_id[0]["_prev"] is None
    for i in range(1, 3000):
        assert (by_id[i]["_prev"]["id"], by_id[i]["_prev"]["v"]) == (i - 1, by_id[i - 1]["v"])


def test_percentile_is_exact_with_a_hot_class(spark):
    k = F.col("id")
    log = spark.range(4000).select(
        F.expr("TIMESTAMP_NTZ '2024-01-01 00:30:00'").alias("start_time"),
        F.when(k % 3 == 0, "busy").when(k % 400 == 1, "empty").otherwise((k % 5).cast("string")).alias("service_class"),
        F.when(k % 400 == 1, None).otherwise((k * k) % 977).alias("total_time"))
    groups: dict[str, list[int]] = {}
    for r in log.collect():
        groups.setdefault(r["service_class"], []).append(r["total_time"])
    for p in (0.0, 0.5, 0.95, 1.0):
        got = class_percentile(log, "hour", p, "2024-01-01 01:00:00", "2 HOURS").collect()
        assert len(got) == len(groups)
        for r in got:
            known = [v for v in groups[r["service_class"]] if v is not None]
            assert r["query_count"] == len(groups[r["service_class"]])
            if known:
                assert abs(r[f"p{round(p * 100)}_execution_time"] - np.percentile(known, p * 100)) < 1e-9
                assert abs(r["avg_execution_time"] - statistics.mean(known)) < 1e-9
            else:
                assert r[f"p{round(p * 100)}_execution_time"] is None


def test_approximate_percentile_is_close(spark):
    log = spark.range(1000).select(F.expr("TIMESTAMP_NTZ '2024-01-01 00:30:00'").alias("start_time"),
                                   F.lit("a").alias("service_class"), F.col("id").alias("total_time"))
    row = class_percentile(log, "hour", 0.95, "2024-01-01 01:00:00", "2 HOURS", approx=True).first()
    assert abs(row["p95_execution_time"] - 949) <= 2


def test_column_profile(spark):
    df = spark.createDataFrame([(1, "a", 10), (2, "a", 20), (3, "b", 30), (4, None, 40)], "id INT, s STRING, n INT")
    got = {r["column_name"]: r for r in column_profile(df, ["s", "n"], ["id"], 2).collect()}
    assert got["s"]["n_distinct"] == 2 and got["s"]["null_fraction"] == 0.25
    assert got["s"]["most_common_vals"] == ["a", "b"] and got["s"]["most_common_freqs"] == [0.5, 0.25]
    assert got["n"]["correlation"] == 1.0


def test_most_common_values_whole_table(spark):
    got = most_common_values(skewed(spark), ["v"], 1).first()
    assert got["value"] == "7" and got["value_count"] >= 1000


def test_approximate_profile(spark):
    got = {r["column_name"]: r for r in approximate_profile(skewed(spark), ["v"], 3).collect()}
    assert abs(got["v"]["n_distinct"] - 101) <= 6
    assert got["v"]["most_common_vals"][0] == "7"


def test_encoding_profile_suggestions(spark):
    k = F.col("id")
    df = spark.range(1000).select(
        k, (k % 2 == 0).alias("flag"), F.floor(k / 200).alias("block"), (k * 7919 % 1009).alias("noise"),
        F.concat(F.lit("c"), k % 7).alias("code"), F.concat(F.lit("u"), k).alias("name"),
        F.repeat(F.concat(F.lit("text"), k), 100).alias("body"))
    columns = ["id", "flag", "block", "noise", "code", "name", "body"]
    got = {r["column_name"]: r for r in encoding_profile(df, columns, ["id"]).collect()}
    assert {c: r["suggested_encoding"] for c, r in got.items()} == {
        "id": "DELTA", "flag": "RUNLENGTH", "block": "RUNLENGTH", "noise": "TEXT255", "code": "BYTEDICT",
        "name": "TEXT255", "body": "ZSTD"}
    assert got["block"]["run_count"] == 5 and got["id"]["rising_share"] == 1.0
