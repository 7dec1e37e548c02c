"""Figures and changes kept by load: sketches per period, value counts, the change log."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sparkwh.functions.scalars import ts
from sparkwh.operators import loads, profiles, sketches
from sparkwh.plans import history, parts
from sparkwh.session import new_path

from .conftest import rows

KIND = "operation_type"


def values(spark, n, start=0):
    """One value a minute; a third of the rows in one group, some values and groups NULL."""
    return spark.range(start, start + n).select(
        (ts("2024-01-01 00:00:00") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("id"))).alias("at"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("g"), (F.col("id") % 5).cast("string"))).alias("g"),
        F.when(F.col("id") % 7 > 0, F.xxhash64("id") % 10_000).alias("v"), (F.col("id") % 97).alias("member"))


def test_parts_replace_each_other_and_show_when_broken(spark):
    folder = new_path(spark, "parts")
    assert parts.kept(spark, folder, "k BIGINT").count() == 0
    for part, n in (("01", 3), ("b", 4), ("01", 2)):
        parts.put(spark.range(n).toDF("k"), folder, part)
    assert rows(parts.kept(spark, folder, "k BIGINT")) == [(0, "01"), (0, "b"), (1, "01"), (1, "b"), (2, "b"), (3, "b")]
    with pytest.raises(ValueError, match="not a name"):
        parts.put(spark.range(1).toDF("k"), folder, "../x")
    with pytest.raises(Exception):
        parts.put(spark.range(9).select(F.raise_error(F.lit("lost")).cast("bigint").alias("k")), folder, "b")
    with pytest.raises(ValueError, match="put again"):
        parts.kept(spark, folder, "k BIGINT")
    parts.put(spark.range(1).toDF("k"), folder, "b")
    assert rows(parts.kept(spark, folder, "k BIGINT")) == [(0, "01"), (0, "b"), (1, "01")]


@pytest.mark.parametrize("kind", ["bigint", "double"])
def test_sketches_of_any_span(spark, kind):
    data = values(spark, 20_000).withColumn("v", F.col("v").cast(kind)).cache()
    pieces = [sketches.period_sketches(data.where(F.pmod(F.xxhash64("at"), F.lit(3)) == k), "hour", "at", ["g"], "v", "member") for k in range(3)]
    kept = pieces[0].unionByName(pieces[1]).unionByName(pieces[2])
    start, end = "2024-01-02 05:00:00", "2024-01-09 01:00:00"
    inside = data.where((F.col("at") >= ts(start)) & (F.col("at") < ts(end)))
    want = {r["g"]: r for r in inside.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.avg("v").alias("a"), F.min("v").alias("low"), F.max("v").alias("high"),
                                                       F.collect_list("v").alias("all"), F.count_distinct("member").alias("d")).collect()}
    got = sketches.span_report(kept, "hour", start, end, ["g"], 0.95).collect()
    assert {r["g"] for r in got} == set(want) and None in want
    for r in got:
        w, n = want[r["g"]], len(want[r["g"]]["all"])
        assert (r["row_count"], r["least"], r["most"]) == (w["n"], w["low"], w["high"]) and r["average"] == pytest.approx(w["a"])
        assert sum(x < r["percentile"] for x in w["all"]) / n - 0.0105 <= 0.95 <= sum(x <= r["percentile"] for x in w["all"]) / n + 0.0105
        assert abs(r["distinct"] - w["d"]) <= 1 + 0.065 * w["d"]
    again = sketches.merged_sketches(kept, ["period", "g"])
    assert again.count() == data.groupBy(F.date_trunc("hour", "at"), "g").count().count()
    assert rows(sketches.span_report(again, "hour", start, end, ["g"], 0.95).drop("percentile", "average")) == rows(
        sketches.span_report(kept, "hour", start, end, ["g"], 0.95).drop("percentile", "average"))
    with pytest.raises(Exception, match="borders"):
        sketches.span_report(kept, "hour", "2024-01-02 05:30:00", end, ["g"], 0.95).collect()
    data.unpersist()


def test_sketches_of_nothing(spark):
    none = sketches.period_sketches(values(spark, 0), "hour", "at", ["g"], "v", "member")
    assert sketches.span_report(none, "hour", "2024-01-01 00:00:00", "2024-01-02 00:00:00", ["g"], 0.5).count() == 0
    nulls = values(spark, 50).withColumn("v", F.lit(None).cast("bigint")).withColumn("member", F.lit(None).cast("bigint"))
    got = sketches.span_report(sketches.period_sketches(nulls, "hour", "at", [], "v", "member"), "hour", "2024-01-01 00:00:00", "2024-01-02 00:00:00", [], 0.5)
    assert rows(got) == [(50, None, None, None, None, 0)]


def test_profile_reads_new_parts_only(spark):
    folder, shape = new_path(spark, "counts"), "column_name STRING, value STRING, value_count BIGINT"
    columns = ["g", "v", "member"]
    old, new = values(spark, 500), values(spark, 300, 500)
    parts.put(profiles.value_counts(old, columns), folder, "1")
    parts.put(profiles.value_counts(new.limit(10), columns), folder, "2")
    parts.put(profiles.value_counts(new, columns), folder, "2")
    got = profiles.profile_of_counts(profiles.added_counts(parts.kept(spark, folder, shape)), 5)
    whole = profiles.column_profile(old.unionByName(new), columns, None, 5).drop("correlation")
    assert rows(got.select(*whole.columns)) == rows(whole)


def batches(spark):
    """Four batches that insert, update and delete the same few keys in every order, also keys that are not there."""
    kinds = ["INSERT", "UPDATE", "DELETE", None]
    data = [[] for _ in range(4)]
    for key in range(256):
        for b in range(4):
            kind = kinds[key // 4 ** b % 4]
            if kind:
                data[b].append((key % 256, f"{kind[0]}{b}", b, kind))
    for b in range(4):
        data[b].append((None, f"n{b}", b, "INSERT"))
        data[b].append((None, f"u{b}", b, "UPDATE"))
    return [spark.createDataFrame(d, f"k BIGINT, a STRING, b INT, {KIND} STRING") for d in data]


@pytest.mark.parametrize("there", ["k % 2 = 0", "k % 2 = 1"])
def test_rebuilt_equals_batches_applied_one_by_one(spark, there):
    base = spark.range(256).toDF("k").where(there).select("k", F.lit("base").alias("a"), F.lit(-1).alias("b"), F.lit(7).alias("other"))
    base = base.unionByName(spark.createDataFrame([(None, "x", 0, 8)], "k BIGINT, a STRING, b INT, other INT"))
    folder, given = new_path(spark, "log"), batches(spark)
    for n, batch in enumerate(given):
        history.record(batch, folder, ["k"], n)
    log, state, states = history.recorded(spark, folder, given[0].schema), base, []
    for n, batch in enumerate(given):
        state = spark.createDataFrame(loads.apply_changes(state, batch, ["k"], ["a", "b"]).collect(), base.schema)
        states.append(state)
        assert rows(history.rebuilt(base, log, ["k"], n)) == rows(state), n
    assert rows(history.rebuilt(states[1], log, ["k"], 3, after=1)) == rows(states[3])
    assert rows(history.rebuilt(base, log, ["k"], -1)) == rows(base)


def test_only_the_batches_asked_for_are_read(spark):
    folder, given = new_path(spark, "log"), batches(spark)
    for n, batch in enumerate(given):
        history.record(batch, folder, ["k"], n)
    log = history.recorded(spark, folder, given[0].schema)
    read = log.where("batch_id > 1 and batch_id <= 2").select(F.input_file_name().alias("f")).distinct().collect()
    assert read and all("batch_id=2" in r["f"] for r in read)
    twice = given[0].unionByName(given[0])
    with pytest.raises(Exception, match="more than one source row"):
        history.record(twice, folder, ["k"], 9)
