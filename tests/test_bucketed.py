"""Core table in buckets of (symbol, year): no row exchange, hot symbols spread, null keys, other sessions."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from marketlens.operators import returns as rt
from marketlens.operators import risk
from marketlens.session import scratch_dir
from marketlens.sources import bucketed
from marketlens.sources import fixtures as fx
from tests.conftest import SMALL

N = 6


@pytest.fixture
def no_broadcast(spark):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _store(df, n=N):
    name = f"t_{uuid.uuid4().hex}"
    path = scratch_dir(df.sparkSession, name)
    return bucketed.store_bucketed(df, name, path, n), path


def _core(spark, bars):
    daily = rt.daily_returns(_store(bars)[0], keep_segment=True, columns=rt.RISK_INPUT)
    return daily, _store(daily)[0]


def _exchanges(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]


def _row_exchanges(df) -> list[str]:
    """Exchanges by the segment columns; the carry's own, to the join, names its columns otherwise."""
    return [line for line in _exchanges(df) if "_seg#" in line.split("ENSURE")[0]]


def test_returns_peak_and_mart_move_no_rows(spark, no_broadcast):
    daily, core = _core(spark, fx.orders_bars(spark, SMALL))
    for df in (daily, rt.running_max(core, shared=False), risk.risk_metrics(core, shared=False)):
        assert _exchanges(df) and not _row_exchanges(df), _exchanges(df)
    # the same models over bars that aren't in buckets do move them
    assert _row_exchanges(rt.daily_returns(fx.orders_bars(spark, SMALL), keep_segment=True, columns=rt.RISK_INPUT))


def test_a_model_over_buckets_is_stored_without_an_exchange_of_rows(spark, no_broadcast):
    daily = rt.daily_returns(_store(fx.orders_bars(spark, SMALL))[0], keep_segment=True, columns=rt.RISK_INPUT)
    rows = daily.select(*[c for c in daily.columns if c != "symbol"])
    assert not _row_exchanges(rows.repartition(N, "_key", "_seg"))


def test_equal_to_the_shuffled_models_with_null_symbols_and_dates(spark, bars):
    rows = [("HOT", i, 100 + (i * 37 % 91)) for i in range(0, 4000)] + [("B", 5 * i, 10 + i) for i in range(300)]
    rows += [("Z", 0, 0.0), ("Z", 1, 5.0), ("Z", 400, 4.0), ("ONE", 3, 1.0), (None, 1, 2.0), (None, 2, 3.0), (None, 800, 4.0)]
    df = bars(rows).union(bars([("Q", 1, 1.0)]).withColumn("date", F.lit(None).cast("date"))).union(bars([("Q", 2, 3.0)]))
    daily, core = _core(spark, df)
    plain = rt.daily_returns(df, keep_segment=True, columns=rt.RISK_INPUT)

    def as_set(x):
        return sorted(map(str, x.collect()))

    assert as_set(daily.select("symbol", "date", "close", "daily_return")) \
        == as_set(plain.select("symbol", "date", "close", "daily_return"))
    cols = ["symbol", "date", "close", "rolling_max"]
    assert as_set(rt.running_max(core, shared=False).select(*cols)) == as_set(rt.running_max(plain).select(*cols))
    assert as_set(risk.risk_metrics(core, shared=False)) == as_set(risk.risk_metrics(plain))


def test_a_hot_symbol_lies_in_many_buckets_one_file_each(spark, bars):
    t, _ = _store(bars([("HOT", i, 1.0) for i in range(0, 9000, 3)]))
    per = t.groupBy(F.expr("_metadata.file_name").alias("f")).count().collect()
    assert len(per) >= N - 1 and max(r["count"] for r in per) < 0.5 * sum(r["count"] for r in per)


def test_another_session_attaches_the_table(spark, no_broadcast, bars):
    _, path = _store(bars([("A", i, 1.0 + i) for i in range(900)] + [("B", i, 2.0) for i in range(30)]))
    t = bucketed.attach(spark.newSession(), f"t_{uuid.uuid4().hex}", path, N)
    other = t.sparkSession
    other.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    other.conf.set("spark.sql.adaptive.enabled", "false")
    daily = rt.daily_returns(t)
    assert not _row_exchanges(daily) and daily.filter("daily_return IS NOT NULL").count() == 928
    assert daily.filter(F.col("date") == dt.date(2025, 1, 1)).first().prev_close == 366.0


def test_empty_bars(spark, bars):
    df = bars([("A", 1, 1.0)]).limit(0)
    daily, core = _core(spark, df)
    assert daily.count() == 0 and risk.risk_metrics(core, shared=False).count() == 0
