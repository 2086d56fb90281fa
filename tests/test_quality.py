"""Data-quality suite: one-pass counts, unique, singular test and the gate."""

import datetime as dt

import pytest

from marketlens.operators import quality as dq
from marketlens.plans import pipeline as pl
from marketlens.session import scratch_dir
from tests.conftest import day


def _raw(spark, rows):
    return spark.createDataFrame(
        [(day(i), c, c, c, c, 1, s, dt.datetime(2024, 1, 1)) for s, i, c in rows],
        "date date, open double, high double, low double, close double, volume long, "
        "symbol string, ingested_at timestamp_ntz")


def test_report_counts_failures(spark):
    raw = _raw(spark, [("A", 0, 10.0), ("A", 1, -1.0), (None, 2, 3.0)])
    rep = {(r.model, r.column_name, r.test): r.failures
           for r in dq.quality_report({"raw_stock_prices": raw}).collect()}
    assert rep[("raw_stock_prices", "close", "expression")] == 1
    assert rep[("raw_stock_prices", "symbol", "not_null")] == 1
    assert rep[("raw_stock_prices", "date", "not_null")] == 0


def test_unique_and_range(spark):
    mart = spark.createDataFrame([("A", "B", 0.5), ("A", "C", 1.5), ("B", "C", None)],
                                 "symbol_1 string, symbol_2 string, correlation double")
    assert dq.correlation_out_of_range(mart).count() == 1
    dup = spark.createDataFrame([("A",), ("A",), (None,), (None,)], "symbol string")
    assert [r.value for r in dq.unique_failures(dup, "symbol").collect()] == ["A"]


def test_gate_stops_the_pipeline(spark):
    raw = _raw(spark, [("A", i, c) for i, c in enumerate([10.0, 11.0, -2.0, 12.0])] +
               [("B", i, c) for i, c in enumerate([5.0, 6.0, 7.0, 6.5])])
    with pytest.raises(dq.DataQualityError, match="close"):
        pl.run_batch(raw, ["A", "B"], scratch_dir(spark, "gate"), gate=True)


def test_gate_passes_clean_data(spark):
    raw = _raw(spark, [("A", i, c) for i, c in enumerate([10.0, 9.0, 11.0, 8.0, 12.0])] +
               [("B", i, c) for i, c in enumerate([5.0, 4.0, 7.0, 3.0, 6.5])])
    alerts = spark.sql("SELECT 'A' AS symbol, 'PRICE_DROP' AS alert_type, timestamp_ntz'2024-01-02' AS triggered_at")
    out = pl.run_batch(raw, ["A", "B"], scratch_dir(spark, "gate_ok"), alerts=alerts, gate=True)
    assert out["quality_report"].filter("failures > 0").count() == 0
    assert out["mart_risk_metrics"].count() == 2


def test_every_declared_test_fails_on_the_dirty_tables(spark):
    import __spark_entry__ as E

    rows = E.queries()["dq_report_dirty"](spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(dq.SUITE) + 1
    assert all(r.failures > 0 for r in rows), [r for r in rows if not r.failures]


def test_gate_counts_tests_that_cannot_run(spark):
    report = dq.quality_report({"raw_stock_prices": spark.sql(
        "SELECT date'2024-01-01' AS date, 'A' AS symbol, 1.0D AS close")})
    assert report.count() == len(dq.SUITE) + 1
    with pytest.raises(dq.DataQualityError, match="not run"):
        dq.assert_quality(report)
