"""Risk and portfolio marts.

``risk_metrics`` is one grouped aggregation over the return rows: the
drawdown's running maximum is added to those same rows first, so the
reference's separate drawdown branch and its LEFT JOIN collapse into the
same ``groupBy(symbol)`` (one shuffle instead of two).  Every aggregate is
partial (map-side combined); the exact 5th percentile keeps a value→count
map per symbol, whose size is bounded by the distinct returns (6 decimals).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions.scalar import TRADING_DAYS
from marketlens.operators.returns import running_max, valid_returns

RISK_COLUMNS = ["symbol", "trading_days", "avg_daily_return_pct", "daily_volatility_pct",
                "annual_volatility_pct", "max_daily_loss_pct", "max_daily_gain_pct",
                "var_95_pct", "sharpe_ratio", "max_drawdown_pct"]

SUMMARY_COLUMNS = ["symbol", "trading_days", "avg_close", "min_close", "max_close",
                   "avg_volume", "latest_close", "latest_date"]


def _drawdown(close="close", peak="rolling_max") -> Column:
    return F.try_divide(F.col(peak) - F.col(close), F.nullif(F.col(peak), F.lit(0.0)))


def _sqrt_days() -> Column:
    return F.sqrt(F.lit(float(TRADING_DAYS)))


def var_95_value(ret="daily_return") -> Column:
    """Historical 95 % VaR: 5th percentile of returns, linear interpolation."""
    return F.percentile(F.col(ret), F.lit(0.05))


def _by_symbol(rows: DataFrame):
    """Group by symbol - through the segmented rows' ``_key`` struct when they
    carry it, so every branch of the plan reads the same columns and the row
    shuffle is shared rather than repeated."""
    if "_key" in rows.columns:
        return rows.groupBy("_key"), [F.col("_key.symbol").alias("symbol")]
    return rows.groupBy("symbol"), ["symbol"]


def risk_metrics(daily: DataFrame, shared: bool = True) -> DataFrame:
    """Per-symbol risk mart (percent figures rounded to 4 places); ``shared=False`` for ``daily`` stored in buckets."""
    rows = running_max(daily, shared)
    r = F.col("daily_return")
    grouped, sym = _by_symbol(rows)
    agg = grouped.agg(
        F.count(F.lit(1)).alias("trading_days"),
        F.avg(r).alias("_avg"),
        F.stddev_samp(r).alias("_sd"),
        F.min(r).alias("_min"),
        F.max(r).alias("_max"),
        var_95_value().alias("_var"),
        F.max(_drawdown()).alias("_dd"),
    )
    return risk_figures_of(agg, sym)


def risk_figures_of(agg: DataFrame, sym: list) -> DataFrame:
    """The mart's figures from a symbol's aggregates."""
    return agg.select(
        *sym, "trading_days",
        F.round(F.col("_avg") * 100, 4).alias("avg_daily_return_pct"),
        F.round(F.col("_sd") * 100, 4).alias("daily_volatility_pct"),
        F.round(F.col("_sd") * _sqrt_days() * 100, 4).alias("annual_volatility_pct"),
        F.round(F.col("_min") * 100, 4).alias("max_daily_loss_pct"),
        F.round(F.col("_max") * 100, 4).alias("max_daily_gain_pct"),
        F.round(F.col("_var") * 100, 4).alias("var_95_pct"),
        F.round(F.try_divide(F.col("_avg"), F.nullif(F.col("_sd"), F.lit(0.0))) * _sqrt_days(), 4)
        .alias("sharpe_ratio"),
        F.round(F.col("_dd") * 100, 4).alias("max_drawdown_pct"),
    )


def risk_ranking(mart: DataFrame) -> DataFrame:
    """The mart as read by reports: by annual volatility, highest first."""
    return mart.orderBy(F.col("annual_volatility_pct").desc_nulls_last(), "symbol")


def max_drawdown(daily: DataFrame) -> DataFrame:
    """Largest fall from the running peak, percent (a positive number)."""
    grouped, sym = _by_symbol(running_max(daily))
    return (grouped.agg(F.round(F.max(_drawdown()) * 100, 4).alias("max_drawdown_pct"))
            .select(*sym, "max_drawdown_pct"))


def var_95(daily: DataFrame) -> DataFrame:
    return (valid_returns(daily).groupBy("symbol")
            .agg(F.round(var_95_value() * 100, 4).alias("var_95_pct")))


def latest_prices(daily: DataFrame, bars: DataFrame | None = None) -> DataFrame:
    """Bars on the global latest date (uncorrelated scalar subquery, run once).

    ``bars`` is the frame the daily rows were computed from (same rows, same
    symbol/date/close), or the stored table: the latest rows need none of the
    return columns, so reading them there skips the returns window entirely.
    """
    src = daily if bars is None else bars
    last_date = src.select(F.max("date")).scalar()
    return (src.filter(F.col("date") == last_date)
               .select("symbol", F.col("close").alias("latest_close"),
                       F.col("date").alias("latest_date")))


def _unique_summary(daily: DataFrame) -> DataFrame:
    """The summary's sources for one bar per (symbol, date): the price figures of the rows with
    a return and the last bar from one aggregation, read once; the global last date
    is the largest among the symbols (a window over one row per symbol)."""
    def valid(c):
        return F.when(F.col("daily_return").isNotNull(), F.col(c))

    per = daily.groupBy("symbol").agg(
        F.count("daily_return").alias("_n"), F.avg(valid("close")).alias("_avg_close"),
        F.min(valid("close")).alias("_min_close"), F.max(valid("close")).alias("_max_close"),
        F.avg(valid("volume")).alias("_avg_volume"), F.max_by("close", "date").alias("latest_close"),
        F.max("date").alias("latest_date"))
    per = per.withColumn("_last", F.max("latest_date").over(Window.partitionBy()))
    return per.filter((F.col("_n") > 0) & (F.col("latest_date") == F.col("_last"))).withColumn("_mult", F.lit(1))


def portfolio_summary(daily: DataFrame, bars: DataFrame | None = None, unique_bars: bool = False) -> DataFrame:
    """Per-symbol price summary joined (inner) to the latest bar.

    Both sides are aggregated before they meet: the return rows to one row
    per symbol, the latest bars to one row per (symbol, close, date) with
    its multiplicity.  Joining the aggregates and scaling the count by that
    multiplicity gives exactly the rows of join-then-group, while the join
    only ever sees per-symbol rows (AQE broadcasts it when it is small).
    With ``unique_bars`` (one bar per symbol and date) one pass gives both sides.
    """
    return summary_figures_of(_unique_summary(daily) if unique_bars else _joined_summary(daily, bars))


def summary_figures_of(rows: DataFrame) -> DataFrame:
    return rows.select(
        "symbol",
        (F.col("_n") * F.col("_mult")).alias("trading_days"),
        F.round("_avg_close", 4).alias("avg_close"),
        F.round("_min_close", 4).alias("min_close"),
        F.round("_max_close", 4).alias("max_close"),
        F.round("_avg_volume", 0).alias("avg_volume"),
        "latest_close", "latest_date",
    )


def _joined_summary(daily: DataFrame, bars: DataFrame | None) -> DataFrame:
    stats = valid_returns(daily).groupBy("symbol").agg(
        F.count(F.lit(1)).alias("_n"),
        F.avg("close").alias("_avg_close"),
        F.min("close").alias("_min_close"),
        F.max("close").alias("_max_close"),
        F.avg("volume").alias("_avg_volume"),
    )
    latest = (latest_prices(daily, bars).groupBy("symbol", "latest_close", "latest_date")
              .agg(F.count(F.lit(1)).alias("_mult")))
    return stats.join(latest, "symbol", "inner")
