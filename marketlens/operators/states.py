"""Stored states of the marts, per symbol (or pair) and year, and the marts from them.

A state holds what a year of bars adds to a mart in a form that merges with the years
around it, so that a new bar changes the state of its year and no other:

* risk and price figures: number, mean and squared deviations of the returns and their
  extremes; peak, low and worst fall of the closes; sums; the first and the last bar;
  and the sorted returns, at most one a day, for the exact 5th percentile.  The first
  return of a year needs the year before: it is left out and added when states are
  merged in year order, from the two bars on either side of the border.
* correlation: the moments of each pair over the year's dates (``correlation.merged``),
  the first returns included, so a year that changes also changes the pairs of the
  year after it.

The worst fall over two stretches is the worst of either, or the fall from the first
one's peak to the second one's low; this needs prices of at least 0, as the tests of the
raw table demand.  Bars are one per symbol and date (``dedup_latest``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.operators import correlation as corr
from marketlens.operators.risk import risk_figures_of, summary_figures_of, var_95_value

RISK_STATE = ("symbol string, first_date date, first_close double, first_volume long, last_date date, last_close double, "
              "n long, mean double, m2 double, min_return double, max_return double, peak double, low double, fall double, "
              "sum_close double, sum_volume double, returns array<double>, year int")
PAIR_STATE = "symbol_1 string, symbol_2 string, " + ", ".join(f"{c} double" for c in corr.MOMENTS) + ", year int"


def _return(close, prev) -> Column:
    return F.round(F.try_divide(close - prev, F.nullif(prev, F.lit(0.0))), 6)


def _fall(peak, close) -> Column:
    return F.try_divide(peak - close, F.nullif(peak, F.lit(0.0)))


def risk_states(bars: DataFrame) -> DataFrame:
    """One state per (symbol, year); a group is a symbol's bars of one year, whatever the history."""
    w = Window.partitionBy("symbol", "year").orderBy("date")
    rows = bars.select("symbol", F.year("date").alias("year"), "date", "close", "volume")
    rows = rows.withColumn("r", _return(F.col("close"), F.lag("close").over(w)))
    valid = lambda c: F.when(F.col("r").isNotNull(), F.col(c))
    peak = F.max(valid("close")).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumn("fall", F.when(F.col("r").isNotNull(), _fall(peak, F.col("close"))))
    states = rows.groupBy("symbol", "year").agg(
        F.min("date").alias("first_date"), F.min_by("close", "date").alias("first_close"),
        F.min_by("volume", "date").alias("first_volume"), F.max("date").alias("last_date"),
        F.max_by("close", "date").alias("last_close"), F.count("r").alias("n"), F.avg("r").alias("mean"),
        (F.var_pop("r") * F.count("r")).alias("m2"), F.min("r").alias("min_return"), F.max("r").alias("max_return"),
        F.max(valid("close")).alias("peak"), F.min(valid("close")).alias("low"), F.max("fall").alias("fall"),
        F.sum(valid("close")).alias("sum_close"), F.sum(valid("volume")).cast("double").alias("sum_volume"),
        F.sort_array(F.collect_list("r")).alias("returns"))
    return states.select(*[c.split()[0] for c in RISK_STATE.split(", ")])


def carried(states: DataFrame) -> DataFrame:
    """States with the last close before their year and the year that it is from."""
    order = Window.partitionBy("symbol").orderBy("year")
    return states.withColumns({"prev_close": F.lag("last_close").over(order), "prev_year": F.lag("year").over(order)})


def whole_years(states: DataFrame) -> DataFrame:
    """States with the return over the border before their year taken in, and the peak of all years before."""
    s = carried(states).withColumn("r0", _return(F.col("first_close"), F.col("prev_close")))
    some = F.col("r0").isNotNull()
    border = lambda c: F.when(some, F.col(c))
    n, mean = F.col("n"), F.coalesce("mean", F.lit(0.0))
    n1 = n + F.when(some, 1).otherwise(0)
    off = F.coalesce(F.col("r0") - mean, F.lit(0.0))
    s = s.select(
        "symbol", "year", "last_date", "last_close", n1.alias("n"),
        F.when(n1 > 0, mean + off / n1).alias("mean"),
        (F.coalesce("m2", F.lit(0.0)) + off * off * n / F.greatest(n1, F.lit(1))).alias("m2"),
        F.least("min_return", "r0").alias("min_return"), F.greatest("max_return", "r0").alias("max_return"),
        F.greatest("peak", border("first_close")).alias("peak"), F.least("low", border("first_close")).alias("low"),
        F.greatest("fall", border("first_close") * 0 / F.nullif(F.col("first_close"), F.lit(0.0)),
                   _fall(border("first_close"), F.col("low"))).alias("fall"),
        F.coalesce(F.col("sum_close"), F.lit(0.0)).alias("sum_close"), F.coalesce("sum_volume", F.lit(0.0)).alias("sum_volume"),
        F.coalesce(border("first_close"), F.lit(0.0)).alias("close0"),
        F.coalesce(border("first_volume"), F.lit(0)).alias("volume0"),
        F.concat("returns", F.array_compact(F.array("r0"))).alias("returns"))
    before = Window.partitionBy("symbol").orderBy("year").rowsBetween(Window.unboundedPreceding, -1)
    return s.withColumn("fall", F.greatest("fall", _fall(F.max("peak").over(before), F.col("low"))))


def risk_mart(states: DataFrame) -> DataFrame:
    """``mart_risk_metrics`` from the states: reads one row per symbol and year, and no bar."""
    years = whole_years(states)
    symbol = Window.partitionBy("symbol")
    years = years.withColumn("all", F.sum(F.col("n") * F.col("mean")).over(symbol) / F.nullif(F.sum("n").over(symbol), F.lit(0)))
    off = F.col("mean") - F.col("all")
    figures = years.groupBy("symbol").agg(
        F.sum("n").alias("trading_days"), F.first("all").alias("_avg"),
        (F.sum("m2") + F.sum(F.col("n") * off * off)).alias("m2"), F.min("min_return").alias("_min"),
        F.max("max_return").alias("_max"), F.max("fall").alias("_dd")).filter("trading_days > 0")
    deviation = F.sqrt(F.try_divide(F.col("m2"), F.nullif(F.col("trading_days") - 1, F.lit(0))))
    tails = (years.select("symbol", F.explode("returns").alias("daily_return"))
             .groupBy("symbol").agg(var_95_value().alias("_var")))
    return risk_figures_of(figures.withColumn("_sd", deviation).join(tails, "symbol"), ["symbol"])


def summary_mart(states: DataFrame) -> DataFrame:
    """``mart_portfolio_summary`` from the states."""
    per = whole_years(states).groupBy("symbol").agg(
        F.sum("n").alias("_n"), (F.sum("sum_close") + F.sum("close0")).alias("close"), F.min("low").alias("_min_close"),
        F.max("peak").alias("_max_close"), (F.sum("sum_volume") + F.sum("volume0")).alias("volume"),
        F.max_by("last_close", "last_date").alias("latest_close"), F.max("last_date").alias("latest_date"))
    per = per.withColumn("_last", F.max("latest_date").over(Window.partitionBy()))       # one row per symbol
    per = per.filter((F.col("_n") > 0) & (F.col("latest_date") == F.col("_last"))).withColumns(
        {"_avg_close": F.col("close") / F.col("_n"), "_avg_volume": F.col("volume") / F.col("_n"), "_mult": F.lit(1)})
    return summary_figures_of(per)


def returns_of_years(bars: DataFrame, states: DataFrame) -> DataFrame:
    """Daily returns of whole years of ``bars``; the first ones from the closes that the states carry."""
    year = Window.partitionBy("symbol", "year").orderBy("date")
    before = carried(states).select(F.col("symbol").alias("_s"), F.col("year").alias("_y"), "prev_close")
    rows = bars.select("symbol", F.year("date").alias("year"), "date", "close")
    rows = rows.withColumns({"prev": F.lag("close").over(year), "first": F.row_number().over(year) == 1})
    rows = rows.join(before, (F.col("symbol") == F.col("_s")) & (F.col("year") == F.col("_y")), "left")
    prev = F.when(F.col("first"), F.col("prev_close")).otherwise(F.col("prev"))
    return rows.select("date", "symbol", "close", _return(F.col("close"), prev).alias("daily_return"))


def pair_states(daily: DataFrame, universe: Sequence[str]) -> DataFrame:
    """Moments per (pair of configured symbols, year)."""
    names = F.array(*[F.lit(u) for u in universe])
    parts = corr.pair_moments(daily, universe, unique_bars=True, period=F.year("date"))
    return parts.select(F.get(names, F.col("i")).alias("symbol_1"), F.get(names, F.col("j")).alias("symbol_2"),
                        *corr.MOMENTS, F.col("period").alias("year"))


def correlation_mart(states: DataFrame, universe: Sequence[str]) -> DataFrame:
    """``mart_correlation`` from the states of all years."""
    at = F.create_map(*[x for i, u in enumerate(universe) for x in (F.lit(u), F.lit(i))])
    pairs = states.withColumns({"i": at[F.col("symbol_1")], "j": at[F.col("symbol_2")]})
    return corr.correlation_of(corr.merged(pairs), universe)
