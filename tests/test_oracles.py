"""Every registered query against its SQL oracle on the smallest data."""

import oracle
import pytest

import __spark_entry__ as contract

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()

@pytest.fixture(scope="module")
def duck(small):
    return oracle.connect(small)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_matches_oracle(spark, duck, small, name):
    assert oracle.check(spark, duck, small, name, QUERIES[name], ORACLES[name]) is None


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_runs(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["pickup_hour_ts", "pickup_location_id", "trip_count", "avg_distance"]
    assert frame.count() == 743


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
