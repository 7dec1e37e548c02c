from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sparkwh.session import builder  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def event_log_dir(tmp_path_factory):
    return tmp_path_factory.mktemp("eventlog")


@pytest.fixture(scope="session")
def spark(tmp_path_factory, event_log_dir):
    base = tmp_path_factory.mktemp("spark")
    session = builder("tests", **{
        "spark.master": "local[8]", "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "6g", "spark.sql.warehouse.dir": str(base / "warehouse"),
        "spark.checkpoint.dir": str(base / "shared"), "spark.eventLog.enabled": "true",
        "spark.eventLog.dir": event_log_dir.as_uri(), "spark.eventLog.compress": "false",
        "spark.eventLog.rolling.enabled": "false"}).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def plan_of():
    """Text of the physical plan."""
    def text(df) -> str:
        return df._jdf.queryExecution().executedPlan().toString()
    return text


@pytest.fixture
def no_broadcast(spark):
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
