"""Hand-worked edge cases of the tick side (parse, change, rules, severity)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketlens.functions.scalar import alert_severity, nanos_to_date
from marketlens.operators import alerts as al
from marketlens.sources.ticks import parse_ticks


def _types(df):
    return sorted(r["alert_type"] for r in df.collect())


def test_one_tick_no_alert(ticks):
    assert _types(al.alerts(ticks([("A", 0, 10)]))) == []


def test_drop_boundary_is_strict(ticks):
    assert "PRICE_DROP" not in _types(al.alerts(ticks([("A", 0, 100), ("A", 1, 97)])))
    assert "PRICE_DROP" in _types(al.alerts(ticks([("A", 0, 128), ("A", 1, 124)])))


def test_anomaly_needs_six_ticks(ticks):
    five = [("A", i, p) for i, p in enumerate([1, 1, 1, 1, 2])]
    six = [("A", i, p) for i, p in enumerate([1, 1, 1, 1, 1, 2])]
    assert "PRICE_ANOMALY" not in _types(al.alerts(ticks(five)))
    rows = {r["alert_type"]: r for r in al.alerts(ticks(six)).collect()}
    assert rows["PRICE_ANOMALY"]["metric_value"] == pytest.approx(5 / 6 ** 0.5)
    assert rows["PRICE_ANOMALY"]["price_at_alert"] == 2.0


def test_volatility_rule(ticks):
    rows = {r["alert_type"]: r for r in al.alerts(ticks([("A", 0, 10), ("A", 1, 12)])).collect()}
    assert rows["HIGH_VOLATILITY"]["metric_value"] == pytest.approx((2 ** 0.5) / 11)


def test_tick_change(ticks):
    out = al.tick_change(ticks([("A", 0, 10), ("A", 1, 11), ("A", 2, 11)])).orderBy("event_time").collect()
    assert [r["change_pct"] for r in out] == [0.0, 10.0, 0.0]
    assert [r["direction"] for r in out] == [None, "up", "flat"]


def test_bad_json_and_missing_symbol_dropped(spark):
    raw = spark.createDataFrame([("not json",), ('{"price":2}',),
                                 ('{"symbol":"A","price":1.5,"timestamp":"2026-01-01T00:00:00+00:00"}',)],
                                "value string")
    out = parse_ticks(raw).collect()
    assert len(out) == 1 and out[0]["symbol"] == "A" and out[0]["event_time"] is not None


def test_iso_timestamp_with_offset(spark):
    raw = spark.createDataFrame([('{"symbol":"A","price":1,"timestamp":"2026-01-01T01:00:00+01:00"}',)],
                                "value string")
    t = parse_ticks(raw).select(F.col("event_time").cast("timestamp_ntz")).first()[0]
    assert t == dt.datetime(2026, 1, 1, 0, 0)     # session zone is UTC in tests


def test_nanosecond_date(spark):
    v = spark.range(1).select(nanos_to_date(F.lit(1767225600000000000)).alias("d")).first()["d"]
    assert v == dt.date(2026, 1, 1)
    v = spark.range(1).select(nanos_to_date(F.lit(1767225600000000000 - 1)).alias("d")).first()["d"]
    assert v == dt.date(2025, 12, 31)


def test_severity(spark):
    df = spark.createDataFrame([("HIGH_VOLATILITY",), ("PRICE_DROP",), ("PRICE_ANOMALY",)], "t string")
    assert [r[0] for r in df.select(alert_severity("t")).collect()] == ["high", "low", "low"]


def test_window_alerts_match_per_window_batches(ticks):
    rows = [("A", i * 3600, p) for i, p in enumerate([10, 10, 10, 10, 10, 20])] + \
           [("A", 86400 + i * 3600, p) for i, p in enumerate([5, 4])]
    out = al.window_alerts(ticks(rows)).collect()
    by_day = {(r["triggered_at"].day, r["alert_type"]) for r in out}
    assert (2, "PRICE_ANOMALY") in by_day and (3, "PRICE_DROP") in by_day
    assert len({r["alert_id"] for r in out}) == len(out)
