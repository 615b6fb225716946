"""Every registered query against its SQL twin on the smallest tables."""

import pytest
from compare import database, difference

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
SLOW = {"fit_forest", "fit_gbt"}
# The window of these has no row at the smallest scale.
MAY_BE_EMPTY = {"mart_congestion", "zscore_anomaly", "sensor_health", "transfer_cost", "threshold_alerts", "stream_anomaly_live"}


@pytest.fixture(scope="module")
def con(data):
    return database(data)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_matches_sql(spark, data, con, key):
    problem = difference(spark, con, QUERIES[key], ORACLES[key], data)
    if problem == "no rows" and key in MAY_BE_EMPTY:
        return
    assert problem is None, problem


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLES) - SLOW))
def test_runs(spark, data, key):
    assert QUERIES[key](spark, data).count() > 0


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
