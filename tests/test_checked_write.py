"""Tests in the write pass, rejected records, and quantile sketches by day."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from marketlens.operators import quality as dq
from marketlens.operators import sketches as sk
from marketlens.plans import pipeline as pl
from marketlens.session import scratch_dir
from marketlens.sources import fixtures as fx
from marketlens.sources import semistructured as ss
from tests.conftest import SMALL


def _rows(report):
    return sorted((r.model, r.column_name, r.test, r.failures) for r in report.collect())


def test_checked_write_counts_and_sorts_out_in_one_pass(spark):
    raw = fx.dirty(fx.orders_raw(spark, SMALL), "raw_stock_prices")
    seen = spark.sparkContext.accumulator(0)
    counted = raw.rdd.map(lambda r: (seen.add(1), r)[1]).toDF(raw.schema)      # how often the model's rows are made
    stored = dq.write_checked(counted, scratch_dir(spark, "checked"), "raw_stock_prices")
    assert seen.value == raw.count()
    want = [r for r in _rows(dq.quality_report({"raw_stock_prices": raw}, singular=False)) if r[0] == "raw_stock_prices"]
    assert [r for r in _rows(dq.checked_report({"raw_stock_prices": stored})) if r[0] == "raw_stock_prices"] == want
    assert any(r[3] for r in want)
    assert sorted(map(str, stored.table.collect())) == sorted(map(str, raw.collect()))
    bad = raw.filter("date IS NULL OR symbol IS NULL OR close IS NULL OR close < 0")
    assert stored.quarantine.count() == bad.count() > 0
    plan = stored.quarantine._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "quarantined" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_absent_models_and_clean_tables(spark):
    clean = dq.write_checked(fx.orders_raw(spark, SMALL), scratch_dir(spark, "checked"), "raw_stock_prices")
    report = dq.checked_report({"raw_stock_prices": clean})
    assert len(_rows(report)) == len(dq.SUITE) + 1
    assert {r[3] for r in _rows(report) if r[0] == "raw_stock_prices"} == {0}
    assert {r[3] for r in _rows(report) if r[0] != "raw_stock_prices"} == {None}
    assert clean.quarantine.collect() == []


def test_batch_run_with_quarantine(spark):
    raw = fx.dirty(fx.orders_raw(spark, SMALL), "raw_stock_prices")
    alerts = fx.dirty(E.q_alerts(spark, SMALL), "risk_alerts")
    runs = [pl.run_batch(raw, fx.ORDERS_UNIVERSE, scratch_dir(spark, "models"), alerts=alerts, gate=False, quarantine=q)
            for q in (False, True)]
    assert _rows(runs[0]["quality_report"]) == _rows(runs[1]["quality_report"])
    for name in ("int_stock_daily", "mart_risk_metrics", "risk_alerts"):
        a, b = (sorted(map(str, r[name].select(*sorted(r[name].columns)).collect())) for r in runs)
        assert a == b and a
    failing = runs[1]["quarantine"]
    assert failing.filter("model = 'risk_alerts'").count() == alerts.filter(
        "symbol IS NULL OR triggered_at IS NULL OR alert_type = 'FOREIGN'").count()
    with pytest.raises(dq.DataQualityError):
        pl.run_batch(raw, fx.ORDERS_UNIVERSE, scratch_dir(spark, "models"), quarantine=True)


LINES = ['{"date":0,"open":1,"high":1.5,"low":"0.5","close":1e1,"volume":"7","symbol":"A","ingested_at":"2024-01-01T00:00:00"}',
         '{"date":"86400000000000","symbol":"B","extra":{"a":[1]}}', "{}", "null", "7", '"text"', "[{}]", "", "{\"date\":",
         '{"date":1.5,"symbol":"C"}', '{"symbol":["D"],"close":{"x":1},"volume":true}', '{"ingested_at":"yesterday"}', '{"close":null}']


def test_drifted_records(spark):
    rows, bad = ss.write_loaded(spark.createDataFrame([(x,) for x in LINES], "value string"), scratch_dir(spark, "json"))
    got = {r.symbol: r for r in rows.collect() if r.symbol}
    assert (got["A"].low, got["A"].close, got["A"].volume, str(got["A"].date)) == (0.5, 10.0, 7, "1970-01-01")
    assert str(got["B"].date) == "1970-01-02" and got["B"].close is None
    why = {r.value: list(r.reasons) for r in bad.collect()}
    assert all(why[x] == [ss.NO_OBJECT] for x in ("null", "7", '"text"', "[{}]", "", "{\"date\":"))
    assert "ingested_at: no timestamp" in why['{"ingested_at":"yesterday"}']
    assert {"close: no double"} <= set(why[LINES[10]])
    assert "{}" not in why and '{"close":null}' not in why
    assert rows.count() + bad.count() == len(LINES)


def test_sketches_do_not_grow_with_rows_and_keep_their_error(spark):
    def ticks(n):
        r = F.rand(5) * F.rand(6) - 0.3
        return spark.range(n).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 4)).alias("symbol"),
                                     F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 5).cast("int")).alias("day"),
                                     F.round(r, 6).alias("r"))

    sizes = {}
    for n in (20_000, 400_000):
        path = scratch_dir(spark, "sketches")
        returns = ticks(n).persist()
        sk.write_day_sketches(returns, path)
        sk.write_day_sketches(returns.filter("day = date'2024-01-03'"), path)             # a day anew: replaced
        found = sk.var_95_of_sketches(sk.read_day_sketches(spark, path))
        errors = {r.symbol: r for r in sk.rank_error(found, returns).collect()}
        assert sum(r.n for r in found.collect()) == n and len(errors) == 5
        assert all(r.rank_error <= sk.RANK_ERROR for r in errors.values())
        sizes[n] = max(r.sketch_bytes for r in found.collect())
        returns.unpersist()
    assert sizes[400_000] < 1.5 * sizes[20_000]
    assert sk.var_95_of_sketches(sk.read_day_sketches(spark, scratch_dir(spark, "none"))).collect() == []
