"""Tick statistics and the three alert rules.

``tick_stats`` is one grouped aggregation (stddev, mean, max, min and the
latest price as ``max_by`` over an (event_time, seq) key) - no per-symbol driver
loop, no second job per key.  ``alert_rows`` turns each stats row into 0-3
alert rows with ``inline`` over an array of rule structs, so the whole
"metrics -> rules -> rows" step is a projection of the aggregate.

The grouping keys are a parameter: ``["symbol"]`` reproduces the per-batch
scope of the streaming job, ``[window(event_time, d), "symbol"]`` gives
event-time windows that batch and streaming compute identically.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions.scalar import (
    ALERT_TYPES, DROP_THRESHOLD, VOLATILITY_THRESHOLD, ZSCORE_THRESHOLD, deterministic_id,
    direction, guarded_ratio, pct_change, utc_wall_clock,
)
from marketlens.operators.sequential import epoch_units, order_key, segmented_lag

STAT_COLUMNS = ["n_ticks", "volatility", "avg_price", "max_price", "min_price", "latest_price"]


def _latest(key: Column, price="price") -> Column:
    # rows without a price never count as "latest" (they carry nothing to report)
    p = F.col(price)
    return F.max_by(p, F.when(p.isNotNull(), key))


def latest_key(ticks: DataFrame) -> Column:
    """Tick order: event time, then ``seq`` when the source has one.

    A ``decimal(38,0)`` key (not a struct) keeps the stats aggregate hash-based.
    """
    return order_key(ticks, "event_time", F.col("seq") if "seq" in ticks.columns else None)


def stat_aggs(key: Column) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n_ticks"),
        F.stddev_samp("price").alias("volatility"),
        F.avg("price").alias("avg_price"),
        F.max("price").alias("max_price"),
        F.min("price").alias("min_price"),
        _latest(key).alias("latest_price"),
    ]


def tick_stats(ticks: DataFrame, keys: Sequence = ("symbol",)) -> DataFrame:
    """Per-key price statistics (partial aggregation before the shuffle)."""
    return ticks.groupBy(*keys).agg(*stat_aggs(latest_key(ticks)))


def tick_latest(ticks: DataFrame) -> DataFrame:
    """Latest price and its time per symbol (ties on time broken by ``seq``)."""
    has_price = F.col("price").isNotNull()
    return ticks.groupBy("symbol").agg(
        _latest(latest_key(ticks)).alias("latest_price"),
        F.max(F.when(has_price, F.col("event_time"))).alias("latest_time"))


MICROS_PER_HOUR = 3_600_000_000


def tick_change(ticks: DataFrame, segment_micros: int = MICROS_PER_HOUR) -> DataFrame:
    """Previous price per symbol (by event time), percent change and direction.

    The lag is segmented by event-time bucket (an hour by default), so a
    symbol carrying a third of all ticks - even on one busy day - is still
    spread over many tasks.
    """
    seg = F.floor(epoch_units(ticks, "event_time") / F.lit(segment_micros))
    prev = segmented_lag(ticks, "symbol", ["event_time", "seq"], "price", seg, "prev_price")
    volume = [c for c in ("volume",) if c in ticks.columns]
    return prev.select("symbol", "event_time", "seq", "price", "prev_price", *volume,
                       pct_change("price", "prev_price").alias("change_pct"),
                       direction("price", "prev_price").alias("direction"))


def alert_rows(stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """0-3 alerts per stats row: HIGH_VOLATILITY, PRICE_DROP, PRICE_ANOMALY.

    NULL statistics count as 0.0; the current price is the latest tick's,
    else the mean.  All thresholds are strict.
    """
    vol = F.coalesce(F.col("volatility"), F.lit(0.0))
    avg = F.coalesce(F.col("avg_price"), F.lit(0.0))
    mx = F.coalesce(F.col("max_price"), F.lit(0.0))
    cur = F.coalesce(F.col("latest_price"), avg)
    zscore = F.when(vol > 0, F.abs(cur - avg) / vol)
    rules = F.array(
        F.struct(F.lit(ALERT_TYPES[0]).alias("alert_type"),
                 guarded_ratio(vol, avg).alias("metric_value"),
                 F.lit(VOLATILITY_THRESHOLD).alias("threshold_value")),
        F.struct(F.lit(ALERT_TYPES[1]).alias("alert_type"),
                 guarded_ratio(mx - cur, mx).alias("metric_value"),
                 F.lit(DROP_THRESHOLD).alias("threshold_value")),
        F.struct(F.lit(ALERT_TYPES[2]).alias("alert_type"),
                 zscore.alias("metric_value"),
                 F.lit(ZSCORE_THRESHOLD).alias("threshold_value")),
    )
    return (stats.select(*keys, cur.alias("price_at_alert"), F.inline(rules))
            .filter(F.col("metric_value") > F.col("threshold_value")))


def alerts(ticks: DataFrame, keys: Sequence = ("symbol",)) -> DataFrame:
    """Alert rows for arbitrary grouping keys (names of the key columns kept)."""
    stats = tick_stats(ticks, keys)
    key_names = [k if isinstance(k, str) else None for k in keys]
    if None in key_names:
        raise ValueError("alerts(): pass key columns by name; add windows with window_alerts()")
    return alert_rows(stats, key_names)


def window_alerts(ticks: DataFrame, window: str = "1 day") -> DataFrame:
    """Alerts per (symbol, tumbling event-time window), in the alert table's shape.

    ``alert_id`` is derived from (symbol, type, window start), so recomputing
    or replaying a window yields the same ids; ``triggered_at`` is the
    window end (a data time, not the wall clock).
    """
    stats = (ticks.groupBy(F.window("event_time", window).alias("w"), "symbol")
             .agg(*stat_aggs(latest_key(ticks))))
    return to_alert_table(alert_rows(stats, ["w", "symbol"]))


def to_alert_table(rows: DataFrame) -> DataFrame:
    """Window alert rows -> alert table; window bounds as UTC wall-clock."""
    instant = rows.schema["w"].dataType["start"].dataType.typeName() == "timestamp"

    def ntz(c):
        return utc_wall_clock(F.col(c)) if instant else F.col(c)

    start, end = ntz("w.start"), ntz("w.end")
    return rows.select(
        deterministic_id("symbol", "alert_type", start).alias("alert_id"),
        "symbol", "alert_type",
        F.round("metric_value", 6).alias("metric_value"),
        F.col("threshold_value"),
        F.col("price_at_alert"),
        end.alias("triggered_at"),
    )
