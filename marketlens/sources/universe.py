"""The configured symbols as a stored table, joined where they are needed.

A universe is rows ``symbol, ord``: ``ord`` is the pair and page order, a
negative one switches a symbol off.  Plans over it don't grow with the number of
symbols, and bars laid out in ``symbol=`` folders are pruned at run time by the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SCHEMA = "symbol string, ord int"


def write_universe(universe: DataFrame, path: str) -> str:
    """Store ``symbol, ord``; one file, since it is configuration."""
    (universe.select("symbol", F.col("ord").cast("int").alias("ord")).coalesce(1)
     .write.mode("overwrite").parquet(path))
    return path


def read_universe(spark: SparkSession, path: str) -> DataFrame:
    """The symbols switched on, under a given schema."""
    return spark.read.schema(SCHEMA).parquet(path).filter("ord >= 0 AND symbol IS NOT NULL")


def positions(universe: DataFrame) -> DataFrame:
    """(symbol, k): each symbol once, numbered 0, 1, ... by ``ord`` (ties by symbol)."""
    once = universe.filter("symbol IS NOT NULL").groupBy("symbol").agg(F.min("ord").alias("ord"))
    number = F.row_number().over(Window.orderBy("ord", "symbol")) - 1     # rows of the configuration only
    return once.select("symbol", number.cast("int").alias("k"))


def of_universe(df: DataFrame, universe: DataFrame) -> DataFrame:
    """The rows of configured symbols (a semi join; ``symbol=`` folders of others aren't read)."""
    return df.join(universe.select("symbol"), "symbol", "left_semi").select(*df.columns)


def write_by_symbol(bars: DataFrame, path: str) -> str:
    """Bars in a folder per symbol; a symbol of many rows is several files."""
    bars.hint("rebalance", "symbol").write.mode("overwrite").partitionBy("symbol").parquet(path)
    return path


def read_by_symbol(spark: SparkSession, path: str, bars: DataFrame) -> DataFrame:
    """What ``write_by_symbol`` stored of ``bars``, in its columns and types."""
    return spark.read.schema(bars.schema).parquet(path).select(*bars.columns)
