"""Every queries() key against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from tests.conftest import SMALL
from tests.oracle import ORDERED, compare, duck

SQL = E.oracle_sql()
#: Queries of the optional modules may have no SQL form; those have tests of their own.
EXTRA = {k for m in E.EXTRA for k in m.queries()}


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_every_key_has_an_oracle():
    assert set(E.queries()) - EXTRA == set(SQL) - EXTRA


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    info = compare(spark, con, E.queries()[name], SQL[name], SMALL, name in ORDERED)
    assert info["schema_ok"], info
    assert info["spark_rows"] == info["oracle_rows"], info
    assert info["values_ok"], info


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[0] == "symbol" and df.count() > 0


ZONE_SENSITIVE = ["tick_parse", "tick_encode", "tick_stream", "alerts", "stream_alerts_windowed",
                  "stream_alerts", "raw_load", "nanos_to_date", "alerts_timeline", "dedup_latest"]


@pytest.mark.parametrize("name", ZONE_SENSITIVE)
def test_results_do_not_depend_on_session_zone(spark, con, name):
    """Tick times are UTC instants and dates are zone-free: a non-UTC session
    gives the same rows."""
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        info = compare(spark, con, E.queries()[name], SQL[name], SMALL)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert info["values_ok"] and info["spark_rows"] == info["oracle_rows"], info
