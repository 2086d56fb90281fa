"""Value-at-risk at tick volume: mergeable quantile sketches of returns, stored by day.

The exact percentile of the risk mart keeps a count per distinct return of a symbol, which
daily bars bound and ticks don't.  Here each (symbol, day) keeps a KLL sketch: its
size depends on ``K`` and the logarithm of the row count alone, sketches are built
map-side and merged after the shuffle, and days add up to any span, so a new day
costs its own ticks.  The sketch's value at 5 % has a rank within ``RANK_ERROR`` of it
(at 99 % confidence, as the sketch's authors state it for ``K``); KLL draws random numbers,
so two runs may differ within that bound.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DateType, DoubleType, LongType, StringType, StructField, StructType

from marketlens.operators.alerts import tick_change
from marketlens.sources.tables import read_or_empty

#: Sketch size, and the rank error that goes with it (published fit for one quantile).
K = 800
RANK_ERROR = 2.296 / K ** 0.9021
VAR_SHARE = 0.05
SKETCHES = StructType([StructField("symbol", StringType()), StructField("n", LongType()), StructField("least", DoubleType()),
                       StructField("most", DoubleType()), StructField("sketch", BinaryType()), StructField("day", DateType())])


def tick_returns(ticks: DataFrame) -> DataFrame:
    """Simple returns of ticks against the symbol's previous price, rounded as those of bars; NULL ones are left out."""
    prev = F.nullif(F.col("prev_price"), F.lit(0.0))
    ret = F.round(F.try_divide(F.col("price") - F.col("prev_price"), prev), 6)
    return tick_change(ticks).select("symbol", F.to_date("event_time").alias("day"), ret.alias("r")).filter("r IS NOT NULL")


def day_sketches(returns: DataFrame) -> DataFrame:
    """One sketch per (symbol, day) with the exact number and extremes."""
    return returns.groupBy("symbol", "day").agg(
        F.count("r").alias("n"), F.min("r").alias("least"), F.max("r").alias("most"),
        F.kll_sketch_agg_double("r", F.lit(K)).alias("sketch")).select(*SKETCHES.fieldNames())


def write_day_sketches(returns: DataFrame, path: str) -> None:
    """Replace the days that ``returns`` cover, whole days that is, and no others."""
    (day_sketches(returns).hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("day").parquet(path))


def read_day_sketches(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, SKETCHES)


def var_95_of_sketches(sketches: DataFrame) -> DataFrame:
    """Per symbol over the given days: returns, VaR as a return and in percent, and the extremes (exact)."""
    merged = sketches.groupBy("symbol").agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"),
                                            F.kll_merge_agg_double("sketch", F.lit(K)).alias("sketch"))
    value = F.kll_sketch_get_quantile_double("sketch", F.lit(VAR_SHARE))
    return merged.select("symbol", "n", "least", "most", value.alias("var_95"), F.round(value * 100, 4).alias("var_95_pct"),
                         F.length("sketch").alias("sketch_bytes"))


def rank_error(estimates: DataFrame, returns: DataFrame) -> DataFrame:
    """How far the rank of each symbol's estimate lies from 5 %, by counting all returns."""
    at = F.col("var_95")
    counts = returns.join(estimates.select("symbol", "var_95"), "symbol").groupBy("symbol").agg(
        F.count_if(F.col("r") < at).alias("below"), F.count_if(F.col("r") <= at).alias("upto"), F.count("r").alias("all"))
    error = F.greatest(F.col("below") / F.col("all") - VAR_SHARE, VAR_SHARE - F.col("upto") / F.col("all"), F.lit(0.0))
    return counts.select("symbol", F.col("all").alias("n"), error.alias("rank_error"))
