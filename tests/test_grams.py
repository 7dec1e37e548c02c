"""Files left out of a text search, and row groups out of a search by key."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sparkwh.plans.layout import Layout, write_files
from sparkwh.session import new_path
from sparkwh.sources import footers, grams, zones

from .conftest import rows

TEXTS = ["SELECT 1 FROM sales", "VACUUM sales", "DELETE FROM orders WHERE a = 'x%y'", "", None, "ab", "ü𝄞ß in ünïcödé", "SELECT * FROM ext_sales_parquet",
         "a\\b", "100% of it"]


def written(spark):
    path = new_path(spark, "texts")
    for text in TEXTS:
        spark.createDataFrame([(text, k) for k in range(3)], "query STRING, k INT").coalesce(1).write.mode("append").parquet(path)
    return path


@pytest.fixture(scope="module")
def noted(spark):
    path = written(spark)
    grams.note_grams(spark, path, "query")
    return path


@pytest.mark.parametrize("pattern", ["%sales%", "%ext_sales%", "%ext\\_sales%", "%x\\%y%", "SELECT%", "%FROM%sales", "%𝄞ß in%", "%nïc_d%", "%", "", "ab", "_b", "%zzz%",
                                     "%a\\\\b%", "100\\% of it", "%sales%never%"])
def test_search_gives_what_like_gives(spark, noted, pattern):
    want = spark.read.parquet(noted).where(F.col("query").like(pattern))
    got = grams.search_text(spark, noted, "query", pattern)
    assert rows(got) == rows(want)
    holding = {r[0] for r in want.select("_metadata.file_path").distinct().collect()}
    opened = grams.files_that_may_hold(spark, noted, "query", pattern)
    assert len(opened) >= len(holding)
    if grams.fixed_parts(pattern) and pattern != "%sales%never%":
        assert len(opened) <= 3  # "%sales%" is in three


def test_new_files_are_opened_until_noted(spark):
    path = written(spark)
    grams.note_grams(spark, path, "query")
    spark.createDataFrame([("nothing", 1)], "query STRING, k INT").coalesce(1).write.mode("append").parquet(path)
    assert len(grams.files_that_may_hold(spark, path, "query", "%VACUUM%")) == 2
    grams.note_grams(spark, path, "query")
    grams.note_grams(spark, path, "query")
    assert len(grams.files_that_may_hold(spark, path, "query", "%VACUUM%")) == 1
    index = grams.stored_grams(spark, path)
    assert index.count() == index.select("file_path", "column_name", "piece").distinct().count()
    assert index.select("file_path").distinct().count() == len(TEXTS) + 1
    assert spark.read.parquet(path).count() == 3 * len(TEXTS) + 1
    with pytest.raises(ValueError, match="plain text"):
        grams.note_grams(spark, path, "k")


def test_indexes_do_not_see_each_other(spark):
    path = new_path(spark, "both")
    write_files(spark.range(100).select("id", F.concat(F.lit("text-"), "id").alias("query")), path, Layout(sort=("id",), files=4))
    grams.note_grams(spark, path, "query")
    zones.note_zones(spark, path, ["id"])
    assert zones.stored_zones(spark, path).count() == 4
    assert len(zones.files_meeting(spark, path, {"id": (F.lit(3), F.lit(4))})) == 1
    assert rows(grams.search_text(spark, path, "query", "%ext-77%").select("id")) == [(77,)]
    assert footers.column_ranges(spark, path, "id", "bigint").count() == 4


def scanned(df) -> int:
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.finalPhysicalPlan() if "AdaptiveSparkPlan" in plan.nodeName() else plan
    scan = plan.collectLeaves().head()
    return scan.metrics().apply("numOutputRows").value()


def test_a_missing_key_reads_no_row_group(spark):
    data = spark.range(40_000).select(F.xxhash64("id").bitwiseAND(F.lit(-2)).alias("key"), "id")
    read = {}
    for name, layout in (("with", Layout(dist="even", files=4, bloom=("key",))), ("without", Layout(dist="even", files=4))):
        path = new_path(spark, name)
        write_files(data, path, layout)
        table = spark.read.schema("key BIGINT, id BIGINT").parquet(path)
        read[name] = scanned(table.where("key = 1")), scanned(table.where(F.col("key") == data.first()["key"]))
        assert table.where(F.col("key") == data.first()["key"]).count() == 1
    assert read["with"][0] == 0 and 0 < read["with"][1] < 40_000 and read["without"][0] > 0
