from __future__ import annotations

from datetime import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from sparkwh.functions.scalars import ts
from sparkwh.operators import loads
from sparkwh.operators.joins import existing, key_violations, missing, missing_within
from sparkwh.operators.reports import latest_version

from .conftest import rows

SCHEMA = "id BIGINT, at TIMESTAMP_NTZ, amount DECIMAL(10,2), status STRING"
COLS = ["at", "amount", "status"]


def make(spark, *data):
    return spark.createDataFrame(
        [(i, dt.fromisoformat(a) if a else None, None if m is None else __import__("decimal").Decimal(m), s)
         for i, a, m, s in data], SCHEMA)


def ids(df, column="id"):
    return sorted((r[column] for r in df.select(column).collect()), key=lambda v: (v is None, v))


@pytest.fixture
def source(spark):
    return make(spark, (-5, "2024-01-01", "1", "a"), (0, "2024-01-02", "2", "b"), (1, "2024-01-02T00:00:00.000001", "3", "c"),
                (2, "2024-01-05", "4", None), (3, "2024-02-01", "5", "e"), (None, None, "6", "f"))


def test_timestamp_first_load_takes_everything_up_to_now(source):
    empty = source.limit(0)
    assert ids(loads.incremental_by_timestamp(source, empty, "at", "2024-01-05")) == [-5, 0, 1, 2]


def test_timestamp_mark_itself_is_out_and_now_is_in(spark, source):
    target = make(spark, (0, "2024-01-02", "2", "b"))
    assert ids(loads.incremental_by_timestamp(source, target, "at", "2024-01-05")) == [1, 2]


def test_late_rows_are_found_with_lookback(spark, source):
    target = make(spark, (0, "2024-01-02", "2", "b"), (2, "2024-01-05", "4", None))
    plain = loads.incremental_by_timestamp(source, target, "at", "2024-01-06")
    late = loads.incremental_by_timestamp(source, target, "at", "2024-01-06", lookback="3 DAYS", keys=["id"])
    assert ids(plain) == [] and ids(late) == [1]
    with pytest.raises(ValueError):
        loads.incremental_by_timestamp(source, target, "at", "2024-01-06", lookback="3 DAYS")


def test_id_first_load_takes_zero_negative_and_null(source):
    assert ids(loads.incremental_by_id(source, source.limit(0), "id")) == [-5, 0, 1, 2, 3, None]


def test_id_later_load_skips_gaps_unless_asked(spark, source):
    target = make(spark, (1, "2024-01-02", "3", "c"))
    assert ids(loads.incremental_by_id(source, target, "id")) == [2, 3]
    assert ids(loads.incremental_by_id(source, target, "id", fill_gaps=True)) == [-5, 0, 2, 3, None]


def test_loading_twice_adds_nothing(source):
    first = loads.incremental_by_timestamp(source, source.limit(0), "at", "2024-03-01")
    assert loads.incremental_by_timestamp(source, first, "at", "2024-03-01").count() == 0
    known = source.where("id IS NOT NULL")
    first = loads.incremental_by_id(known, source.limit(0), "id")
    assert loads.incremental_by_id(known, first, "id").count() == 0


def test_classify_sees_changes_to_and_from_null(spark):
    source = make(spark, (1, None, "1", None), (2, None, "1", "x"), (3, None, "1", "x"), (4, None, "1", "x"),
                  (None, None, "1", "x"))
    target = make(spark, (1, None, "1", "x"), (2, None, "1", None), (3, None, "1", "x"), (9, None, "1", "x"))

    def kinds(**options):
        out = loads.classify_changes(source, target, ["id"], ["status", "amount"], "2024-01-01", created_col="at",
                                     **options)
        return {r["id"]: r["operation_type"] for r in out.collect()}
    assert kinds() == {1: "UPDATE", 2: "UPDATE", 3: "UNCHANGED", 4: "INSERT", None: "INSERT"}
    assert kinds(null_safe=False) == {1: "UNCHANGED", 2: "UNCHANGED", 3: "UNCHANGED", 4: "INSERT", None: "INSERT"}
    assert kinds(detect_deletes=True)[9] == "DELETE"


def test_classify_window_keeps_recent_and_different(spark):
    source = make(spark, (1, "2024-01-01T11:30", "1", "x"), (2, "2023-01-01", "2", "x"), (3, "2023-01-01", "1", "x"),
                  (4, "2024-01-01T11:00", "1", "x"))
    target = make(spark, (1, None, "1", "x"), (2, None, "1", "x"), (3, None, "1", "x"))
    out = loads.classify_changes(source, target, ["id"], ["status", "amount"], "2024-01-01 12:00:00", window="1 HOUR",
                                 created_col="at")
    assert {r["id"]: r["operation_type"] for r in out.collect()} == {1: "UNCHANGED", 2: "UPDATE"}


def test_apply_changes(spark):
    target = make(spark, (1, None, "1", "x"), (2, None, "1", "x"), (3, None, "1", "x"), (None, None, "7", "n"))
    source = make(spark, (1, None, "1", "x"), (2, None, "9", "y"), (5, None, "5", "z"))
    changes = loads.classify_changes(source.withColumn("created_at", F.lit(None)), target, ["id"], ["status", "amount"],
                                     "2024-01-01", detect_deletes=True)
    got = loads.apply_changes(target, changes, ["id"], COLS)
    # The NULL-key row is in no source and so counts as deleted, but no key equals NULL: it stays.
    assert ids(got) == [1, 2, 5, None]
    assert {r["id"]: r["status"] for r in got.collect()} == {1: "x", 2: "y", 5: "z", None: "n"}


def test_purge_and_delete_keep_unknown(spark):
    staged = make(spark, (1, "2024-01-01T10:59:59", "1", "x"), (2, "2024-01-01T11:00", "1", "x"), (3, None, "1", "x"))
    assert ids(loads.purge_staging(staged, "2024-01-01 12:00:00", ts_col="at")) == [2, 3]
    some = make(spark, (1, None, "1", "x"), (2, None, "1", None), (3, None, "1", "y"))
    assert ids(loads.delete_where(some, F.col("status") == "x")) == [2, 3]


def test_latest_version_breaks_ties(spark):
    feed = spark.createDataFrame([(1, 5, 1), (1, 5, 2), (1, None, 9), (2, 1, 1)], "k INT, v INT, t INT")
    assert rows(latest_version(feed, ["k"], "v", ["t"])) == [(1, 5, 2), (2, 1, 1)]


def test_delta_load_tolerance_is_inclusive(spark):
    feed = make(spark, (1, "2024-01-01T12:00", "1", "old"), (1, "2024-01-01T12:10", "2", "new"),
                (2, "2024-01-01T12:00", "1", "x"), (3, "2024-01-01T12:00", "1", "x"), (4, "2024-01-01T10:00", "1", "x"))
    target = make(spark, (1, "2024-01-01T12:04", "1", "x"), (2, "2024-01-01T11:55", "1", "x"),
                  (3, "2024-01-01T11:54:59", "1", "x"), (3, "2020-01-01", "1", "x"))
    got = loads.delta_load(feed, target, ["id"], "at", "2024-01-01 12:30:00", ["amount"])
    assert rows(got.select("id", "status")) == [(1, "new"), (3, "x")]


def test_missing_within_equals_the_pairwise_rule_under_skew(spark):
    """One key holds most rows on both sides."""
    left = spark.range(400).select(F.when(F.col("id") % 3 != 0, 0).otherwise(F.col("id")).alias("k"),
                                   (ts("2024-01-01") + F.make_dt_interval(mins=F.col("id"))).alias("v"))
    right = left.where("minute(v) % 7 = 0").withColumnRenamed("v", "tv")
    got = missing_within(left, right, ["k"], "v", "tv", "5 MINUTES")
    left.createOrReplaceTempView("l"), right.createOrReplaceTempView("r")
    want = spark.sql("""SELECT * FROM l WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.k = l.k
                        AND r.tv >= l.v - INTERVAL 5 MINUTES)""")
    assert rows(got) == rows(want)


def test_upsert_rejects_a_repeated_key(spark):
    target = make(spark, (1, None, "1", "x"))
    source = make(spark, (2, None, "1", "x"), (2, None, "2", "x"), (None, None, "1", "x"), (None, None, "2", "x"))
    with pytest.raises(Exception, match="more than one source row"):
        loads.upsert(target, source, ["id"], COLS).collect()
    fine = make(spark, (2, None, "1", "x"), (None, None, "1", "n"), (None, None, "2", "n"))
    assert ids(loads.upsert(target, fine, ["id"], COLS)) == [1, 2, None, None]


def test_upsert_newer_keeps_later_versions(spark):
    target = make(spark, (1, "2024-01-05", "1", "x"), (2, "2024-01-01", "1", "x"), (3, None, "1", "x"))
    source = make(spark, (1, "2024-01-03", "2", "y"), (2, "2024-01-03", "2", "y"), (3, "2024-01-03", "2", "y"))
    got = loads.upsert(target, source, ["id"], ["amount", "status"], newer="at")
    assert {r["id"]: (r["status"], r["at"].day) for r in got.collect()} == {1: ("x", 5), 2: ("y", 3), 3: ("y", 3)}


def test_both_ways_to_join_give_the_same(spark):
    target = make(spark, *[(i, None, "1", "x") for i in range(0, 60, 2)], (None, None, "7", "kept"))
    source = make(spark, *[(i, None, "2", None) for i in range(40)], (None, None, "3", "n"))

    def everything(small):
        return [rows(loads.upsert(target, source, ["id"], COLS, small=small)), rows(missing(source, target, ["id"], small)),
                rows(existing(source, target, ["id"], small)),
                rows(loads.classify_changes(source, target, ["id"], ["status"], "2024-01-01", created_col="at", small=small))]
    assert everything(True) == everything(False)


def test_upsert_shuffles_each_side_once(spark, plan_of, no_broadcast):
    target, source = (spark.range(100).selectExpr("id", "id AS v") for _ in range(2))
    assert plan_of(loads.upsert(target, source, ["id"], ["v"])).count("Exchange hashpartitioning") == 2
    changes = source.withColumn("operation_type", F.lit("UPDATE"))
    assert plan_of(loads.apply_changes(target, changes, ["id"], ["v"])).count("Exchange hashpartitioning") == 2


@pytest.mark.parametrize("small", [True, False])
def test_repeated_keys_are_an_error(spark, small):
    target = make(spark, (1, None, "1", "x"))
    for twice in ((1, 1), (3, 3)):
        source = make(spark, *[(k, None, "2", "y") for k in twice])
        with pytest.raises(Exception, match="more than one source row"):
            loads.upsert(target, source, ["id"], COLS, small=small).collect()
        with pytest.raises(Exception, match="more than one source row"):
            loads.classify_changes(source, target, ["id"], ["status"], "2024-01-01", created_col="at", small=small).collect()
        with pytest.raises(Exception, match="more than one source row"):
            loads.apply_changes(target, source.withColumn("operation_type", F.lit("INSERT")), ["id"], COLS).collect()
    with pytest.raises(Exception, match="more than one source row"):
        loads.update_from(target, make(spark, (1, None, "2", "y"), (1, None, "3", "z")), ["id"], COLS).collect()


KEYS = st.lists(st.integers(-3, 12), unique=True, max_size=10)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=KEYS, new=KEYS)
def test_upsert_properties(spark, old, new):
    target = make(spark, *[(k, None, "1", "old") for k in old])
    source = make(spark, *[(k, None, "2", "new") for k in new])
    got = loads.upsert(target, source, ["id"], COLS)
    assert {r["id"]: r["status"] for r in got.collect()} == {**dict.fromkeys(old, "old"), **dict.fromkeys(new, "new")}
    assert got.count() == len(set(old) | set(new))
    assert rows(loads.upsert(got, source, ["id"], COLS)) == rows(got)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keys=st.lists(st.integers(-50, 50), unique=True, min_size=1, max_size=40), size=st.integers(1, 12))
def test_batches_are_disjoint_and_cover(spark, keys, size):
    source = make(spark, *[(k, None, "1", "x") for k in keys])
    got = loads.batch_assign(source, source.limit(0), "id", size).select("id", "batch_no").collect()
    order = sorted(keys)
    assert {r["id"]: r["batch_no"] for r in got} == {k: i // size for i, k in enumerate(order)}


def test_key_violations(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (2, None), (3, 1)], "a INT, b INT")
    assert rows(key_violations(df, ["a", "b"])) == [(1, 1, 2, "duplicate key"), (2, None, 1, "null key")]


def test_daily_transform_starts_at_yesterdays_midnight(spark):
    data = [(1, dt(2024, 1, 1)), (2, dt(2023, 12, 31, 23, 59)), (3, dt(2024, 1, 2, 5))]
    staged = spark.createDataFrame(data, "sale_id BIGINT, sale_date TIMESTAMP_NTZ").withColumns(
        {c: F.lit("x") for c in ("customer_id", "product_id", "sale_amount", "region", "store_id")})
    assert ids(loads.daily_transform(staged, "2024-01-02 09:00:00"), "sale_id") == [1, 3]
