"""Every registered query against its SQL on the smallest data set."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from check import compare, duck
from sparkwh.plans.oracle import ORACLE
from sparkwh.plans.queries import REGISTRY

from .conftest import SF

# Sizes in bytes, which plain SQL cannot give; ``compression_counts`` checks the rest of it.
WITHOUT_SQL = {"compression_report"}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_agrees(spark, con, name):
    good, note = compare(spark, con, name, SF)
    assert good and "TYPES" not in note, note


def test_every_query_has_sql():
    assert set(REGISTRY) - set(ORACLE) == WITHOUT_SQL
    assert set(ORACLE) <= set(REGISTRY)
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
