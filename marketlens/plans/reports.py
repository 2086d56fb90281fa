"""Report pages as DataFrames: tables, KPIs, filters, counts, timelines.

Each page is a function of a mart (or of the alert table), KPIs included,
so nothing is computed on the driver.  "First occurrence wins" for arg-max
style KPIs is made explicit: ties go to the smallest symbol.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions.scalar import alert_severity, minute_bucket, sign_class

# Rows the alerts page loads (newest first).
RECENT_ALERTS = 200


def _argbest(value: str, by: str = "symbol", largest: bool = True) -> Column:
    """Symbol with the largest (or smallest) value; ties -> smallest symbol; NULLs skipped."""
    v = F.col(value)
    key = F.struct(-v if largest else v, F.col(by))
    return F.min_by(F.col(by), F.when(v.isNotNull(), key))


# Rows shown by a fetch preview.
PREVIEW_ROWS = 10


def preview(df: DataFrame, order: Sequence, n: int = PREVIEW_ROWS) -> DataFrame:
    """First ``n`` rows in a stated order (a top-k, so no full sort)."""
    return df.orderBy(*order).limit(n)


# --- R1: risk page -----------------------------------------------------------

def risk_figures(mart: DataFrame) -> DataFrame:
    """The page's figures, unordered (what the KPIs read)."""
    return mart.select(
        "symbol",
        F.round("annual_volatility_pct", 2).alias("ann_volatility_pct"),
        F.round("var_95_pct", 2).alias("var_95_daily_pct"),
        F.round("sharpe_ratio", 2).alias("sharpe_ratio"),
        F.round("max_drawdown_pct", 2).alias("max_drawdown_pct"),
        F.round("max_daily_gain_pct", 2).alias("max_daily_gain_pct"),
        F.round("max_daily_loss_pct", 2).alias("max_daily_loss_pct"),
    )


def risk_report(mart: DataFrame) -> DataFrame:
    return risk_figures(mart).orderBy("symbol")


def risk_kpis(report: DataFrame) -> DataFrame:
    return report.agg(
        F.round(F.avg("ann_volatility_pct"), 6).alias("avg_ann_volatility_pct"),
        F.round(F.avg("var_95_daily_pct"), 6).alias("avg_var_95_pct"),
        _argbest("sharpe_ratio").alias("best_sharpe_symbol"),
        _argbest("max_drawdown_pct").alias("worst_drawdown_symbol"),
    )


# --- R2: portfolio page ------------------------------------------------------

def portfolio_figures(summary: DataFrame) -> DataFrame:
    """The page's figures, unordered (what the KPIs read)."""
    base = summary.select(
        "symbol",
        F.round("latest_close", 4).alias("latest_price"),
        F.round("avg_close", 4).alias("avg_price"),
        F.col("avg_volume").alias("total_volume"),
    )
    vs = F.round(F.try_divide(F.col("latest_price") - F.col("avg_price"), F.col("avg_price")) * 100, 2)
    return base.withColumn("vs_avg_pct", vs).withColumn("vs_avg_sign", sign_class("vs_avg_pct"))


def portfolio_overview(summary: DataFrame) -> DataFrame:
    return portfolio_figures(summary).orderBy("symbol")


def portfolio_kpis(overview: DataFrame) -> DataFrame:
    return overview.agg(
        F.sum("total_volume").alias("total_volume"),
        _argbest("total_volume").alias("top_volume_symbol"),
        F.count_if(F.col("vs_avg_pct") > 0).alias("above_avg"),
        F.count(F.lit(1)).alias("n_symbols"),
    )


def portfolio_display(overview: DataFrame) -> DataFrame:
    """The portfolio table as displayed: 4-place prices, thousands-separated
    volume and a signed percentage (values are already rounded, so the text
    is exact)."""
    return overview.select(
        "symbol",
        F.format_string("%.4f", "latest_price").alias("latest_price_text"),
        F.format_string("%.4f", "avg_price").alias("avg_price_text"),
        F.format_number("total_volume", 0).alias("total_volume_text"),
        millions("total_volume").alias("total_volume_label"),
        F.format_string("%+.2f%%", "vs_avg_pct").alias("vs_avg_text"),
    )


def portfolio_kpis_display(kpis: DataFrame) -> DataFrame:
    return kpis.select(
        F.format_number("total_volume", 0).alias("total_volume_text"),
        F.col("top_volume_symbol"),
        F.format_string("%d / %d", "above_avg", "n_symbols").alias("above_avg_text"),
    )


def millions(c) -> Column:
    """A number as the volume labels show it, e.g. 1.2M."""
    return F.format_string("%.1fM", (F.col(c) if isinstance(c, str) else c) / 1e6)


def risk_kpis_display(kpis: DataFrame) -> DataFrame:
    return kpis.select(F.format_string("%.1f%%", "avg_ann_volatility_pct").alias("avg_ann_volatility_text"),
                       F.format_string("%.2f%%", "avg_var_95_pct").alias("avg_var_95_text"),
                       "best_sharpe_symbol", "worst_drawdown_symbol")


# --- R3: alerts page ---------------------------------------------------------

def recent_alerts(alerts: DataFrame, n: int = RECENT_ALERTS) -> DataFrame:
    """Newest ``n`` alerts (a top-k: per-partition top-n, then one merge)."""
    top = alerts.orderBy(F.col("triggered_at").desc_nulls_last(), F.col("alert_id")).limit(n)
    return top.select(
        "alert_id", "symbol", "alert_type",
        F.round("metric_value", 4).alias("metric_value"),
        F.round("threshold_value", 4).alias("threshold_value"),
        F.round("price_at_alert", 4).alias("price_at_alert"),
        "triggered_at",
    )


def days_of(stored: DataFrame) -> list[dt.date | None]:
    """The days of a table laid out by ``day`` (or a sink's), newest first; alerts without a time are the oldest."""
    found = [r.day for r in stored.select("day").distinct().collect()]          # a row per day of history
    return sorted((d for d in found if d is not None), reverse=True) + [d for d in found if d is None]


def by_day(stored: DataFrame) -> Callable[[list], DataFrame]:
    """Alerts of some days of a stored table: a list of folders, nothing else is read."""
    return lambda days: stored.filter(F.col("day").isin([d for d in days if d is not None])
                                      | (F.col("day").isNull() if None in days else F.lit(False)))


def newest_alerts(of_days: Callable[[list], DataFrame], days: Sequence[dt.date | None], n: int = RECENT_ALERTS,
                  reach: dt.timedelta = dt.timedelta(0)) -> DataFrame:
    """``recent_alerts`` of a store laid out by day, from its newest days.

    An alert of a day's folder is triggered before the end of that day plus ``reach`` (the
    window's length where folders go by the window's start).  Days are taken newest
    first, twice as many each time, until the n-th alert is no older than anything
    that the next day can hold; ties at the border are thereby among the days read.
    """
    take = 1
    while True:
        alerts = of_days(list(days[:take]))
        if take >= len(days):
            return recent_alerts(alerts, n)
        top = alerts.orderBy(F.col("triggered_at").desc_nulls_last()).limit(n)
        found, oldest = top.agg(F.count("triggered_at"), F.min("triggered_at")).first()
        end = None if days[take] is None else dt.datetime.combine(days[take] + dt.timedelta(days=1), dt.time()) + reach
        if found == n and (end is None or oldest >= end):
            return recent_alerts(alerts, n)
        take *= 2


def alert_kpis(recent: DataFrame) -> DataFrame:
    return recent.agg(F.count(F.lit(1)).alias("total_alerts"),
                      F.count_distinct("symbol").alias("symbols_affected"),
                      F.max("triggered_at").alias("latest_alert"))


def alert_kpis_display(kpis: DataFrame) -> DataFrame:
    """The alerts KPIs as displayed; the latest alert to the minute."""
    return kpis.select("total_alerts", "symbols_affected",
                       F.coalesce(F.date_format("latest_alert", "yyyy-MM-dd HH:mm"), F.lit("-")).alias("latest_alert_text"))


def alerts_filtered(recent: DataFrame, symbols: Sequence[str] = (),
                    types: Sequence[str] = ()) -> DataFrame:
    """Optional membership filters; an empty list means no filter."""
    out = recent
    if symbols:
        out = out.filter(F.col("symbol").isin(list(symbols)))
    if types:
        out = out.filter(F.col("alert_type").isin(list(types)))
    return out


def alert_filter_values(recent: DataFrame) -> DataFrame:
    """Sorted distinct choices for the two filters, as (field, value) rows."""
    syms = recent.select(F.lit("symbol").alias("field"), F.col("symbol").alias("value"))
    typs = recent.select(F.lit("alert_type").alias("field"), F.col("alert_type").alias("value"))
    return syms.unionByName(typs).distinct().orderBy("field", "value")


def alert_severity_view(recent: DataFrame) -> DataFrame:
    return recent.withColumn("severity", alert_severity("alert_type"))


def alerts_by_symbol(filtered: DataFrame) -> DataFrame:
    return (filtered.groupBy("symbol").agg(F.count(F.lit(1)).alias("n_alerts"))
            .orderBy(F.col("n_alerts").desc(), "symbol"))


def alerts_timeline(filtered: DataFrame) -> DataFrame:
    return (filtered.groupBy(minute_bucket("triggered_at").alias("minute"))
            .agg(F.count(F.lit(1)).alias("n_alerts")).orderBy("minute"))


# --- R4: correlation page ----------------------------------------------------

def correlation_kpis_display(kpis: DataFrame) -> DataFrame:
    def pair(which):
        return F.concat_ws(" / ", f"{which}_symbol_1", f"{which}_symbol_2").alias(f"{which}_pair_text")

    return kpis.select(F.format_string("%.4f", "avg_correlation").alias("avg_correlation_text"),
                       pair("most"), F.format_string("%.4f", "most_correlation").alias("most_correlation_text"),
                       pair("least"), F.format_string("%.4f", "least_correlation").alias("least_correlation_text"))
