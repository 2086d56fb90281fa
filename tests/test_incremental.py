"""Load once, states per year and the marts kept up to date from them."""

import datetime as dt
import glob
import random

import pytest
from pyspark.sql import functions as F

from marketlens.operators import correlation as corr
from marketlens.operators import risk
from marketlens.operators import states as st
from marketlens.operators.returns import daily_returns
from marketlens.plans import incremental as pi
from marketlens.session import scratch_dir
from marketlens.sources import bars as sb
from marketlens.sources import fixtures as fx
from marketlens.sources import incremental as inc
from tests.conftest import SMALL


def _land(rows, root):
    return sb.write_landing(rows, root, F.trunc("date", "month"))


def test_second_load_reads_only_new_files(spark):
    raw = fx.orders_raw(spark, SMALL)
    land, table = scratch_dir(spark, "landing"), scratch_dir(spark, "raw")
    later = F.col("date") >= F.lit("1996-01-01").cast("date")
    _land(raw.filter(~later), land)
    assert inc.load_new_files(spark, land, table) == raw.filter(~later).count()
    _land(raw.filter(later), land)
    assert inc.load_new_files(spark, land, table, files_per_batch=5) == raw.filter(later).count()
    assert inc.load_new_files(spark, land, table) == 0
    stored = inc.read_raw_table(spark, table)
    assert stored.filter("batch_id > 0").filter(~later).count() == 0
    assert stored.select("batch_id").distinct().count() > 2
    assert sorted(map(tuple, inc.raw_bars(stored).collect())) == sorted(map(tuple, raw.collect()))


def test_a_repeated_batch_adds_nothing(spark):
    land, table = scratch_dir(spark, "landing"), scratch_dir(spark, "raw")
    _land(fx.orders_raw(spark, SMALL), land)
    rows = sb.read_landing(spark, land).withColumn("file", F.lit("f"))
    for _ in range(2):
        inc.batch_writer(table)(rows, 7)
    assert inc.read_raw_table(spark, table).count() == rows.count()


def test_tables_before_the_first_load(spark):
    nowhere = scratch_dir(spark, "raw")
    assert inc.read_raw_table(spark, nowhere).collect() == []
    assert pi.refresh_states(spark, nowhere, ["A"]) == []
    assert {n: m.count() for n, m in pi.marts(spark, nowhere, ["A", "B"]).items()} == {
        "mart_risk_metrics": 0, "mart_portfolio_summary": 0, "mart_correlation": 1}


def _files(root, folder):
    return {y: set(glob.glob(f"{root}/{folder}/year={y}/*.parquet")) for y in range(1990, 2003)
            if glob.glob(f"{root}/{folder}/year={y}")}


def test_a_new_date_rewrites_one_year(spark):
    raw = fx.orders_raw(spark, SMALL)
    land, root = scratch_dir(spark, "landing"), scratch_dir(spark, "kept")
    last = raw.agg(F.max("date")).first()[0]
    _land(raw.filter(F.col("date") < F.lit(last)), land)
    pi.run_increment(spark, land, root, fx.ORDERS_UNIVERSE)
    before = {f: _files(root, f) for f in (pi.RISK, pi.PAIRS)}
    sb.write_landing(raw.filter(F.col("date") == F.lit(last)), land, F.lit("2024-01-01").cast("date"))
    inc.load_new_files(spark, land, f"{root}/{pi.RAW}")
    assert pi.refresh_states(spark, root, fx.ORDERS_UNIVERSE) == [last.year]
    for folder, old in before.items():
        now = _files(root, folder)
        assert [y for y in now if now[y] != old.get(y)] == [last.year], folder
    assert pi.refresh_states(spark, root, fx.ORDERS_UNIVERSE) == []
    plan = pi.bars_of_years(spark, root, [1995])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "(year" in plan.split("PartitionFilters")[1]
    for mart in pi.marts(spark, root, fx.ORDERS_UNIVERSE).values():
        assert "/raw" not in mart._jdf.queryExecution().executedPlan().toString()


def test_other_universe_rebuilds_the_pairs(spark):
    land, root = scratch_dir(spark, "landing"), scratch_dir(spark, "kept")
    raw = fx.orders_raw(spark, SMALL)
    _land(raw, land)
    pi.run_increment(spark, land, root, ["C1", "C2"])
    got = pi.run_increment(spark, land, root, ["C3", "C1", "C0"])["mart_correlation"].collect()
    want = corr.correlation(daily_returns(sb.dedup_latest(raw)), ["C3", "C1", "C0"], unique_bars=True).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(got) == 3


CASES = {
    "one bar a year": [(y, 1, 10.0 + y % 7) for y in range(2000, 2012)],
    "zero closes": [(2000, 1, 5.0), (2000, 2, 0.0), (2000, 3, 4.0), (2001, 1, 0.0), (2001, 2, 3.0), (2002, 1, 2.0)],
    "zero at the border": [(2000, 1, 0.0), (2001, 1, 5.0), (2001, 2, 4.0), (2002, 1, 8.0)],
    "years between are missing": [(1999, 300, 9.0), (2003, 2, 12.0), (2003, 9, 6.0), (2009, 1, 7.0)],
    "constant": [(y, d, 5.0) for y in (2000, 2001) for d in (1, 2, 3)],
    "a lone bar": [(2000, 5, 1.0)],
    "two bars over a border": [(2000, 366, 4.0), (2001, 1, 3.0)],
    "no close": [(2000, 1, 4.0), (2000, 2, None), (2000, 3, 5.0), (2001, 1, None), (2001, 2, 6.0), (2001, 3, 3.0)],
    "large and steady": [(y, d, 1e9 + d % 3) for y in (2000, 2001, 2002) for d in range(1, 40)],
}


@pytest.fixture(scope="module")
def case_bars(spark):
    rng = random.Random(6)
    walk, price = [], 100.0
    for y in range(2000, 2006):
        for d in range(1, 366, 3):
            price = max(0.5, price * (1 + rng.gauss(0, 0.03)))
            walk.append((y, d, round(price, 2)))
    rows = [(name, dt.date(y, 1, 1) + dt.timedelta(days=d - 1), c, d) for name, days in {**CASES, "walk": walk}.items()
            for y, d, c in days]
    return spark.createDataFrame(rows, "symbol string, date date, close double, volume long")


def _close(a, b):
    return a == b or (isinstance(a, float) and isinstance(b, float) and a == pytest.approx(b, abs=2e-4))


@pytest.mark.parametrize("kind", ["risk", "summary"])
def test_marts_of_states_equal_the_marts_of_all_bars(spark, case_bars, kind):
    daily = daily_returns(case_bars, columns=["date", "symbol", "close", "daily_return", "volume"])
    states = st.risk_states(case_bars)
    want, got = ((risk.risk_metrics(daily), st.risk_mart(states)) if kind == "risk" else
                 (risk.portfolio_summary(daily, unique_bars=True), st.summary_mart(states)))
    got, want = ({r.symbol: r for r in df.select(*want.columns).collect()} for df in (got, want))
    assert set(got) == set(want) and want
    for s, r in want.items():
        for c in want[s].asDict():
            assert _close(got[s][c], r[c]), (s, c, got[s][c], r[c])


def test_one_pass_summary_equals_the_join(spark, case_bars):
    daily = daily_returns(case_bars, columns=["date", "symbol", "close", "daily_return", "volume"])
    one, two = (risk.portfolio_summary(daily, unique_bars=u) for u in (True, False))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))


def test_correlation_of_states(spark, case_bars):
    names = sorted([*CASES, "walk"])
    shifted = case_bars.filter("symbol = 'walk'").withColumns(
        {"symbol": F.lit("twin"), "close": F.col("close") * (1 + F.dayofyear("date") / 1000)})
    bars = case_bars.unionByName(shifted)
    daily = daily_returns(bars, columns=["date", "symbol", "close", "daily_return"])
    parts = st.pair_states(st.returns_of_years(bars, st.risk_states(bars)), [*names, "twin"])
    got = {r[:2]: r[2] for r in st.correlation_mart(parts, [*names, "twin"]).collect()}
    want = {r[:2]: r[2] for r in corr.correlation(daily, [*names, "twin"], unique_bars=True).collect()}
    assert set(got) == set(want)
    for k, v in want.items():
        assert _close(got[k], v), (k, got[k], v)
    assert want["walk", "twin"] is not None if ("walk", "twin") in want else want["twin", "walk"] is not None


def test_the_raw_rows_of_a_touched_year_are_read_once(spark, monkeypatch):
    """Risk and pair states share the newest loads; only untouched years next to them are read as well."""
    raw = fx.orders_raw(spark, SMALL)
    land, root = scratch_dir(spark, "landing"), scratch_dir(spark, "kept_up")
    read, real = [], pi.bars_of_years
    monkeypatch.setattr(pi, "bars_of_years", lambda s, r, years: read.append(list(years)) or real(s, r, years))
    _land(raw, land)
    pi.run_increment(spark, land, root, fx.ORDERS_UNIVERSE)
    assert len(read) == 1 and len(set(read[0])) == len(read[0]) > 2
    read.clear()
    redo = raw.filter(F.year("date") == 1996).withColumn("close", F.col("close") + 1)
    sb.write_landing(redo, land, F.lit("2024-06-28").cast("date"))
    marts = pi.run_increment(spark, land, root, fx.ORDERS_UNIVERSE)
    assert read == [[1996], [1997]]
    bars = sb.dedup_latest(inc.raw_bars(inc.read_raw_table(spark, pi._at(root, pi.RAW))))
    want = corr.correlation(daily_returns(bars), fx.ORDERS_UNIVERSE, unique_bars=True)
    assert sorted(map(tuple, marts["mart_correlation"].collect())) == sorted(map(tuple, want.collect()))
