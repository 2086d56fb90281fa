"""Hand-worked edge cases of the batch models (returns, risk, summary, correlation)."""

import numpy as np
import pandas as pd
import pytest

from marketlens.operators import correlation as corr
from marketlens.operators import risk
from marketlens.operators.returns import daily_returns
from marketlens.sources.bars import dedup_latest
from tests.conftest import day


def _by(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


def test_first_bar_has_no_return(bars):
    d = _by(daily_returns(bars([("A", 0, 100), ("A", 1, 110)])), "date")
    assert d[day(0)]["daily_return"] is None and d[day(0)]["prev_close"] is None
    assert d[day(1)]["daily_return"] == pytest.approx(0.1)


def test_zero_previous_close(bars):
    d = _by(daily_returns(bars([("A", 0, 100), ("A", 1, 0), ("A", 2, 50)])), "date")
    assert [d[day(i)]["daily_return"] for i in range(3)] == [None, -1.0, None]
    m = risk.risk_metrics(daily_returns(bars([("A", 0, 100), ("A", 1, 0), ("A", 2, 50)]))).first()
    assert m["trading_days"] == 1
    assert m["max_drawdown_pct"] is None           # running max of the only row is 0


def test_drawdown_skips_first_bar(bars):
    m = risk.risk_metrics(daily_returns(bars([("A", 0, 200), ("A", 1, 100), ("A", 2, 90)]))).first()
    assert m["max_drawdown_pct"] == pytest.approx(10.0)


def test_single_return(bars):
    m = risk.risk_metrics(daily_returns(bars([("A", 0, 100), ("A", 1, 110)]))).first()
    assert m["daily_volatility_pct"] is None and m["sharpe_ratio"] is None
    assert m["var_95_pct"] == pytest.approx(10.0)


def test_var_interpolation(bars):
    closes = [100.0]
    for r in (0.01, 0.02, 0.03, 0.04, 0.05):
        closes.append(closes[-1] * (1 + r))
    m = risk.var_95(daily_returns(bars([("A", i, c) for i, c in enumerate(closes)]))).first()
    assert m["var_95_pct"] == pytest.approx(1.2)


def test_constant_series_gives_null_not_error(bars):
    rows = [("A", i, 5) for i in range(4)] + [("B", i, c) for i, c in enumerate([10, 11, 9, 12])]
    daily = daily_returns(bars(rows))
    m = _by(risk.risk_metrics(daily), "symbol")
    assert m["A"]["daily_volatility_pct"] == 0.0 and m["A"]["sharpe_ratio"] is None
    c = corr.correlation(daily, ["A", "B"]).collect()
    assert len(c) == 1 and c[0]["correlation"] is None


def test_disjoint_dates_keep_null_pair(bars):
    rows = [("A", i, 10 + i) for i in (0, 2, 4)] + [("B", i, 20 - i) for i in (1, 3, 5)]
    c = corr.correlation(daily_returns(bars(rows)), ["A", "B", "C"]).collect()
    assert len(c) == 3 and all(r["correlation"] is None for r in c)
    assert [(r["symbol_1"], r["symbol_2"]) for r in c] == [("A", "B"), ("A", "C"), ("B", "C")]


def test_correlation_is_symmetric_and_bounded(bars):
    rows = [("A", i, c) for i, c in enumerate([10, 11, 12, 11, 13, 14])] + \
           [("B", i, c) for i, c in enumerate([5, 5.5, 6.1, 5.9, 6.6, 7.0])]
    daily = daily_returns(bars(rows))
    ab = corr.correlation(daily, ["A", "B"]).first()["correlation"]
    ba = corr.correlation(daily, ["B", "A"]).first()["correlation"]
    assert ab == ba and -1 <= ab <= 1
    mat = _by(corr.correlation_matrix(corr.correlation(daily, ["A", "B"]), ["A", "B"]), "symbol")
    assert mat["A"]["A"] == 1.0 and mat["A"]["B"] == mat["B"]["A"] == ab


def test_missing_latest_bar_drops_symbol(bars):
    rows = [("A", i, 10 + i) for i in range(4)] + [("B", i, 20 + i) for i in range(3)]
    s = _by(risk.portfolio_summary(daily_returns(bars(rows))), "symbol")
    assert set(s) == {"A"}
    assert s["A"]["trading_days"] == 3 and s["A"]["latest_close"] == 13.0


def test_duplicate_bar_latest_load_wins(spark):
    import datetime as dt
    raw = spark.createDataFrame(
        [(day(0), 1.0, 1.0, 1.0, 10.0, 1, "A", dt.datetime(2024, 1, 2)),
         (day(0), 1.0, 1.0, 1.0, 11.0, 1, "A", dt.datetime(2024, 1, 3))],
        "date date, open double, high double, low double, close double, volume long, "
        "symbol string, ingested_at timestamp_ntz")
    out = dedup_latest(raw).collect()
    assert len(out) == 1 and out[0]["close"] == 11.0


def test_adding_a_symbol_leaves_others_unchanged(bars):
    base = [("A", i, c) for i, c in enumerate([10, 12, 11, 13])]
    more = base + [("B", i, c) for i, c in enumerate([3, 2, 4, 5])]
    a1 = _by(risk.risk_metrics(daily_returns(bars(base))), "symbol")["A"].asDict()
    a2 = _by(risk.risk_metrics(daily_returns(bars(more))), "symbol")["A"].asDict()
    assert a1 == a2


def test_correlation_matches_brute_force_on_wide_universe(spark):
    """Gram-block correlation vs pandas pairwise-complete corr: 12 symbols,
    gaps, duplicate bars (MAX wins), one constant and one empty symbol."""
    import math
    import random

    import pandas as pd

    rnd = random.Random(3)
    syms = [f"S{i:02d}" for i in range(12)]
    rows = []
    for s in syms[:-1]:                       # the last symbol has no data at all
        for d in range(120):
            if rnd.random() < 0.25:
                continue
            r = 0.01 if s == "S05" else round(rnd.gauss(0, 0.02), 6)
            rows.append((s, d, r))
            if rnd.random() < 0.05:
                rows.append((s, d, round(r - 0.001, 6)))     # duplicate, smaller
    df = spark.createDataFrame([(day(d), s, r) for s, d, r in rows],
                               "date date, symbol string, daily_return double")
    got = {(r.symbol_1, r.symbol_2): r.correlation for r in corr.correlation(df, syms).collect()}
    wide = (pd.DataFrame(rows, columns=["symbol", "d", "r"]).groupby(["d", "symbol"])["r"].max()
            .unstack().reindex(columns=syms))
    want = wide.corr()                         # pairwise complete, NaN when undefined
    assert len(got) == len(syms) * (len(syms) - 1) // 2
    for (a, b), v in got.items():
        w = want.loc[a, b]
        if a == "S05" or b == "S05" or math.isnan(w):
            assert v is None, (a, b, v)
        else:
            assert v == pytest.approx(round(w, 4), abs=1e-4), (a, b)


def test_ingest_without_any_rows_is_an_error(bars):
    from marketlens.sources.bars import NoDataError, normalise_frames
    empty = bars([("A", 0, 1.0)]).limit(0).select(
        *[c.capitalize() for c in ("date", "open", "high", "low", "close", "volume")])
    with pytest.raises(NoDataError):
        normalise_frames({"A": empty, "B": empty})
    one = bars([("A", 0, 1.0)]).select(
        *[c.capitalize() for c in ("date", "open", "high", "low", "close", "volume")])
    out = normalise_frames({"A": one, "B": empty}).collect()
    assert [(r.symbol, r.close) for r in out] == [("A", 1.0)]


def test_correlation_keeps_precision_for_large_means(spark):
    """Centred moments: series around 1e8 with unit-size moves still give the
    right correlation (raw sums of squares would cancel away every digit)."""
    import random

    import pandas as pd

    rnd = random.Random(5)
    a = [1e8 + rnd.gauss(0, 1) for _ in range(300)]
    b = [x + rnd.gauss(0, 1) for x in a]
    rows = [(day(d), "A", a[d]) for d in range(300)] + [(day(d), "B", b[d]) for d in range(300)]
    df = spark.createDataFrame(rows, "date date, symbol string, daily_return double")
    got = corr.correlation(df, ["A", "B"]).first()["correlation"]
    want = round(pd.Series(a).corr(pd.Series(b)), 4)
    assert got == pytest.approx(want, abs=1e-4)


def test_correlation_of_many_symbols_spreads_over_tasks(spark):
    """300 symbols x 250 days: more than one task works although AQE would merge
    by bytes, no task passes on pairs it hasn't seen, and the result is right."""
    rng = np.random.default_rng(4)
    syms = [f"S{i:03d}" for i in range(300)]
    values = np.round(rng.normal(0, 0.01, (250, 300)) + 0.01 * rng.normal(size=(250, 1)), 6)
    values[rng.random(values.shape) < 0.1] = np.nan
    values[:, 7] = np.nan
    values[5:, 8] = np.nan
    wide = pd.DataFrame(values, columns=syms)
    long = wide.stack().reset_index()
    long.columns = ["d", "symbol", "daily_return"]
    df = spark.createDataFrame(long).selectExpr("date_add(date'2024-01-01', int(d)) AS date", "symbol", "daily_return")
    parts = corr.pair_moments(df, syms, unique_bars=True)
    got = {(r.symbol_1, r.symbol_2): r.correlation for r in corr.correlation(df, syms, unique_bars=True).collect()}
    want = wide.corr()
    assert len(got) == 300 * 299 // 2
    for (a, b), r in got.items():
        w = want.loc[a, b]
        assert (r is None) == bool(np.isnan(w)) and (r is None or abs(r - w) < 6e-5), (a, b, r, w)
    assert parts.count() == sum(int((wide[a].notna() & wide[b].notna()).any())
                                for i, a in enumerate(syms) for b in syms[i + 1:])
    plan = corr.pair_moments(df, syms, unique_bars=True)
    plan.collect()
    final = plan._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    tasks = spark.conf.get("spark.sql.shuffle.partitions")
    assert int(tasks) > 1 and f"{tasks}), REPARTITION_BY_NUM" in final
