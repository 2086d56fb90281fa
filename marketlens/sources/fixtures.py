"""Price datasets derived from the driver's tables.

The reference reads market bars and ticks from live services; here the same
shapes are derived from ``events`` and ``orders`` with plain aggregations, so
their size grows with the tables:

* ``bars_from_events``   dense daily bars: 8 symbols ``U0..U7`` (user_id mod 8)
* ``bars_from_orders``   long, sparse daily bars: ``C0..C7`` (o_custkey mod 8)
* ``raw_from_orders``    one raw bar per order, duplicates per (symbol, date)
* ``ticks_from_events``  price ticks: symbol = event_type, price = value

All of them are one scan plus (for bars) one partially-aggregated shuffle on
(symbol, date); no step depends on the number of distinct keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.operators.sequential import order_key

# Symbols per synthetic universe (keys are taken modulo this number).
UNIVERSE_SIZE = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def universe(prefix: str) -> list[str]:
    """Configured symbol list (the ticker config); order = pair order."""
    return [f"{prefix}{i}" for i in range(UNIVERSE_SIZE)]


EVENTS_UNIVERSE = universe("U")
ORDERS_UNIVERSE = universe("C")


def bars_from_events(events: DataFrame) -> DataFrame:
    """Daily OHLCV bars per ``U<user_id mod 8>``: open/close = first/last value by ts, then event_id."""
    return (
        events.select(
            F.concat(F.lit("U"), (F.col("user_id") % UNIVERSE_SIZE).cast("string")).alias("symbol"),
            F.to_date("ts").alias("date"), order_key(events, "ts", F.col("event_id")).alias("at"), "value")
        .groupBy("symbol", "date")
        .agg(F.min_by("value", "at").alias("open"),
             F.max("value").alias("high"),
             F.min("value").alias("low"),
             F.max_by("value", "at").alias("close"),
             F.count(F.lit(1)).alias("volume"))
        .select("date", "symbol", "open", "high", "low", "close", "volume")
    )


def bars_from_orders(orders: DataFrame) -> DataFrame:
    """Daily bars per ``C<o_custkey mod 8>``; open/close by order key."""
    return (
        orders.select(
            F.concat(F.lit("C"), (F.col("o_custkey") % UNIVERSE_SIZE).cast("string")).alias("symbol"),
            F.to_date("o_orderdate").alias("date"), "o_orderkey", "o_totalprice")
        .groupBy("symbol", "date")
        .agg(F.min_by("o_totalprice", "o_orderkey").alias("open"),
             F.max("o_totalprice").alias("high"),
             F.min("o_totalprice").alias("low"),
             F.max_by("o_totalprice", "o_orderkey").alias("close"),
             F.count(F.lit(1)).alias("volume"))
        .select("date", "symbol", "open", "high", "low", "close", "volume")
    )


def raw_from_orders(orders: DataFrame) -> DataFrame:
    """One raw bar per order (raw table schema); load order = order key.

    ``ingested_at`` is 2024-01-01 plus ``o_orderkey`` seconds, so a larger
    key is a later load of the same (symbol, date).
    """
    return orders.select(
        F.to_date("o_orderdate").alias("date"),
        F.col("o_totalprice").alias("open"),
        F.col("o_totalprice").alias("high"),
        F.col("o_totalprice").alias("low"),
        F.col("o_totalprice").alias("close"),
        F.lit(1).cast("long").alias("volume"),
        F.concat(F.lit("C"), (F.col("o_custkey") % UNIVERSE_SIZE).cast("string")).alias("symbol"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
         + F.make_dt_interval(secs=F.col("o_orderkey").cast("decimal(18,6)"))).alias("ingested_at"),
    )


def ticks_from_events(events: DataFrame) -> DataFrame:
    """Price ticks: symbol = event_type, price = value, event_time = ts (NTZ), volume from the id."""
    return events.select(
        F.col("event_type").alias("symbol"),
        F.col("value").alias("price"),
        F.col("ts").alias("event_time"),
        F.col("event_id").alias("seq"),
        (F.col("event_id") % 1000 + 1).alias("volume"),
    )


# Column replacements (SQL text that both engines read) that break every declared test at least once.
DIRTY = {
    "raw_stock_prices": {
        "date": "CASE WHEN second(ingested_at) = 1 THEN NULL ELSE date END",
        "symbol": "CASE WHEN second(ingested_at) = 2 THEN NULL ELSE symbol END",
        "close": "CASE WHEN second(ingested_at) = 3 THEN NULL WHEN second(ingested_at) = 4 THEN -close ELSE close END"},
    "risk_alerts": {
        "alert_type": "CASE WHEN symbol = 'click' THEN 'FOREIGN' ELSE alert_type END",
        "symbol": "CASE WHEN symbol = 'view' THEN NULL ELSE symbol END",
        "triggered_at": "CASE WHEN symbol = 'purchase' THEN NULL ELSE triggered_at END"},
    "int_stock_daily": {
        "symbol": "CASE WHEN symbol = 'C1' THEN NULL ELSE symbol END",
        "date": "CASE WHEN symbol = 'C2' THEN NULL ELSE date END"},
    "mart_risk_metrics": {
        "symbol": "CASE WHEN symbol = 'C1' THEN 'C2' WHEN symbol = 'C3' THEN NULL ELSE symbol END",
        "daily_volatility_pct": "CASE WHEN symbol = 'C4' THEN NULL WHEN symbol = 'C5' THEN -daily_volatility_pct "
                                "ELSE daily_volatility_pct END",
        "var_95_pct": "CASE WHEN symbol = 'C6' THEN NULL WHEN symbol = 'C7' THEN -var_95_pct ELSE var_95_pct END"},
    "mart_portfolio_summary": {
        "symbol": "CASE WHEN symbol = 'U1' THEN 'U2' WHEN symbol = 'U3' THEN NULL ELSE symbol END",
        "latest_close": "CASE WHEN symbol = 'U4' THEN NULL WHEN symbol = 'U5' THEN -latest_close ELSE latest_close END"},
    "mart_correlation": {
        "symbol_1": "CASE WHEN symbol_1 = 'C6' AND symbol_2 = 'C7' THEN NULL ELSE symbol_1 END",
        "symbol_2": "CASE WHEN symbol_1 = 'C0' AND symbol_2 = 'C1' THEN NULL ELSE symbol_2 END",
        "correlation": "CASE WHEN symbol_1 = 'C1' AND symbol_2 = 'C2' THEN 1.2 "
                       "WHEN symbol_1 = 'C1' AND symbol_2 = 'C3' THEN NULL ELSE correlation END"},
}


def dirty(df: DataFrame, model: str) -> DataFrame:
    """``df`` with the model's replacements applied to the original columns."""
    return df.selectExpr(*[f"{DIRTY[model].get(c, c)} AS {c}" for c in df.columns])


def events_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars_from_events(table(spark, sf_dir, "events"))


def orders_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars_from_orders(table(spark, sf_dir, "orders"))


def orders_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_from_orders(table(spark, sf_dir, "orders"))


def events_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks_from_events(table(spark, sf_dir, "events"))
