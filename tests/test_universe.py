"""The universe as data: the same marts as from a list, plans of one length, folders pruned by the join."""

import random

import __spark_entry__ as E
from marketlens.operators import correlation as corr
from marketlens.session import scratch_dir
from marketlens.sources import fixtures as fx
from marketlens.sources import universe as un
from tests.conftest import SMALL, day

DAILY = "date date, symbol string, daily_return double"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _universe(spark, rows):
    path = un.write_universe(spark.createDataFrame(rows, un.SCHEMA), scratch_dir(spark, "t_universe"))
    return un.read_universe(spark, path)


def test_positions_skip_gaps_repeats_and_switched_off_symbols(spark):
    rows = [("B", 7), ("A", 7), ("C", 2), ("C", 9), ("D", -1), (None, 1)]
    got = sorted(tuple(r) for r in un.positions(_universe(spark, rows)).collect())
    assert got == [("A", 1), ("B", 2), ("C", 0)]


def test_marts_of_a_table_and_of_a_list_agree(spark):
    rng = random.Random(5)
    names = [f"S{i}" for i in range(130)]                      # three blocks of 64
    rng.shuffle(names)
    daily = spark.createDataFrame([(day(i), s, rng.gauss(0, 1) if rng.random() < 0.9 else None)
                                   for s in names[:-2] + ["OTHER"] for i in range(12)], DAILY)
    want = corr.correlation(daily, names, unique_bars=True)
    got = corr.correlation(daily, _universe(spark, [(s, 3 * i) for i, s in enumerate(names)]), unique_bars=True)
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert rows(got) == rows(want) and got.count() == 130 * 129 // 2


def test_universes_of_none_and_of_one_symbol(spark):
    daily = spark.createDataFrame([(day(0), "A", 0.1), (day(1), "A", 0.2)], DAILY)
    for rows in ([], [("A", 0)]):
        assert corr.correlation(daily, _universe(spark, rows)).count() == 0


def test_plan_does_not_grow_with_the_universe(spark):
    daily = E._daily_or(spark, SMALL)
    plans = [len(_plan(corr.correlation(daily, _universe(spark, [(f"C{i}", i) for i in range(n)]), unique_bars=True)))
             for n in (8, 5000)]
    assert abs(plans[0] - plans[1]) < 0.05 * plans[0]


def test_source_is_read_once_beside_the_universe(spark):
    df = E.queries()["mart_correlation_universe"](spark, SMALL)
    df.collect()
    final = _plan(df).split("== Initial Plan ==")[0]
    assert final.count("o_totalprice:double") == 1


def test_join_prunes_the_folders_of_other_symbols(spark):
    bars = fx.orders_bars(spark, SMALL)
    table = un.read_by_symbol(spark, un.write_by_symbol(bars, scratch_dir(spark, "t_by_symbol")), bars)
    df = un.of_universe(table, _universe(spark, [("C1", 0), ("C3", 1), ("C5", -1)]))
    assert "dynamicpruning" in _plan(df)
    assert {r.symbol for r in df.select("symbol").distinct().collect()} == {"C1", "C3"}
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, bars.filter("symbol IN ('C1', 'C3')").select(*df.columns).collect()))
