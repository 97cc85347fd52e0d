"""Every registered query against its comparison SQL on the smallest tables."""

from __future__ import annotations

import os

import pytest
from oracle_check import compare, connect

from pricestrata.queries import load

SF_DIR = os.environ.get("SF_DIR", "/root/testdata/sf0.001")
REGISTRY = load()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, con, name):
    ok, note = compare(spark, con, SF_DIR, REGISTRY[name])
    assert ok is not False, note


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
