"""Every registered query runs; those with an oracle match it."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from compare import DATA, connect, differences

SF_DIR = f"{DATA}/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = connect(SF_DIR)
    yield con
    con.close()


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, duck, name):
    actual = QUERIES[name](spark, SF_DIR).toPandas()
    assert differences(actual, duck.execute(ORACLES[name]).df()) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs_with_rows(spark, name):
    assert not QUERIES[name](spark, SF_DIR).isEmpty()


def test_entry(spark):
    hourly = entry.entry(spark).collect()
    assert 0 < len(hourly) <= 24
    assert sum(r["trips"] for r in hourly) > 0
