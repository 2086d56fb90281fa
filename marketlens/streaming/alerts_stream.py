"""Structured Streaming runners for the alert rules.

Two scopes:

* ``start_micro_batch_alerts`` - the rules over each micro-batch, per symbol
  (the scope of a processing-time trigger).  One set-based job per batch:
  aggregate, rules, write; the source is read once.
* ``start_windowed_alerts`` - the rules per symbol and tumbling event-time
  window.  Each batch writes the statistics of the windows it touched;
  ``read_windowed_alerts`` takes every window's fullest statistics of each feed,
  merges those of the feeds and applies the rules.  All windows are there, the
  open ones too, and the result doesn't depend on how ticks were cut into
  batches or runs.

A windowed run is a feed of its own: its ticks are other ones than those of the
other runs (another source, or a start at the latest offset).  Runs that read the
same ticks again, wholly or in part, must be given one ``feed`` name; the one that
has read most of a window counts.  Feeds whose ticks of a window are all equal
(by number and sum of hashes) count once.

A sink may serve many runs.  A run (one checkpoint) keeps an id in its
checkpoint folder; batches write into ``day=/run_id=/batch_id=`` folders, so a
replayed batch replaces its own output, and nothing else: ids derive from the
run as well.  Checkpoints and sinks belong in shared storage.

Without a watermark no tick is late, and the state holds one row per (window,
symbol).  With one, closed windows leave the state and later ticks are dropped;
``run_to_end`` then raises ``LateTicksError`` unless the caller accepts that.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import (
    DateType, DecimalType, DoubleType, LongType, StringType, StructField, StructType, TimestampNTZType, TimestampType,
)

from marketlens.functions.scalar import deterministic_id, utc_wall_clock
from marketlens.operators.alerts import STAT_COLUMNS, alert_rows, latest_key, stat_aggs, to_alert_table
from marketlens.streaming.compaction import read_compacted

#: What it takes, besides the statistics, to merge them over feeds.
MERGE_COLUMNS = ["n_prices", "latest_at", "ticks_hash"]
_LAYOUT = [StructField("day", DateType()), StructField("run_id", StringType()), StructField("batch_id", LongType())]
_DECIMAL = DecimalType(38, 0)
#: The micro-batch sink: alerts, and the folders that lay them out.
ALERTS = StructType([StructField("alert_id", StringType()), StructField("symbol", StringType()),
                     StructField("alert_type", StringType()), StructField("metric_value", DoubleType()),
                     StructField("threshold_value", DoubleType()), StructField("price_at_alert", DoubleType()),
                     StructField("triggered_at", TimestampNTZType()), *_LAYOUT])
#: The windowed sink: mergeable statistics of a window and symbol as a batch left them.
WINDOW_STATS = StructType([
    StructField("w", StructType().add("start", TimestampType()).add("end", TimestampType())), StructField("symbol", StringType()),
    StructField("n_ticks", LongType()), *[StructField(c, DoubleType()) for c in STAT_COLUMNS[1:]],
    StructField("n_prices", LongType()), StructField("latest_at", _DECIMAL), StructField("ticks_hash", _DECIMAL),
    StructField("feed", StringType()), *_LAYOUT])


class LateTicksError(RuntimeError):
    """Ticks came after their window had left the state."""


def run_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the run that this checkpoint belongs to; made at its first start."""
    path = f"{checkpoint.rstrip('/')}/alert_run"
    spark.createDataFrame([(uuid.uuid4().hex,)], "run_id string").coalesce(1).write.mode("ignore").parquet(path)
    return spark.read.schema("run_id string").parquet(path).first().run_id


def write_batch(rows: DataFrame, sink: str, run: str, batch_id: int) -> None:
    """Replace this batch's folders only (an empty batch has none)."""
    (rows.withColumns({"run_id": F.lit(run), "batch_id": F.lit(batch_id)})
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("day", "run_id", "batch_id").parquet(sink))


def batch_alert_table(batch: DataFrame, batch_id: int, run: str) -> DataFrame:
    """Alert rows of one micro-batch in the alert table's shape, and their day (of the symbol's last tick)."""
    day = F.to_date(F.max("event_time"))
    stats = batch.groupBy("symbol").agg(*stat_aggs(latest_key(batch)), day.alias("day"))
    return alert_rows(stats, ["symbol", "day"]).select(
        deterministic_id("symbol", "alert_type", F.lit(run), F.lit(batch_id)).alias("alert_id"),
        "symbol", "alert_type", "metric_value", "threshold_value", "price_at_alert",
        utc_wall_clock(F.current_timestamp()).alias("triggered_at"), "day")


def micro_batch_writer(sink: str, run: str):
    """``foreachBatch`` callback writing each batch's alerts idempotently."""
    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch_alert_table(batch, batch_id, run), sink, run, batch_id)

    return write


def _trigger(writer, trigger: dict | None):
    return writer.trigger(**(trigger or {"availableNow": True}))


def start_micro_batch_alerts(ticks: DataFrame, sink: str, checkpoint: str,
                             trigger: dict | None = None) -> StreamingQuery:
    """Per-micro-batch alerts; e.g. ``trigger={"processingTime": "10 seconds"}``."""
    run = run_id(ticks.sparkSession, checkpoint)
    w = ticks.writeStream.foreachBatch(micro_batch_writer(sink, run)).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


def merge_aggs(ticks: DataFrame) -> list:
    key, price = latest_key(ticks), F.col("price")
    return [F.count(price).alias("n_prices"), F.max(F.when(price.isNotNull(), key)).alias("latest_at"),
            F.sum(F.xxhash64(price, key).cast("decimal(38,0)")).alias("ticks_hash")]


def window_stats_stream(ticks: DataFrame, window: str = "1 day", watermark: str | None = None) -> DataFrame:
    """Statistics per (event-time window, symbol), as they stand after each batch."""
    src = ticks.withWatermark("event_time", watermark) if watermark else ticks
    return (src.groupBy(F.window("event_time", window).alias("w"), "symbol")
            .agg(*stat_aggs(latest_key(ticks)), *merge_aggs(ticks)))


def start_windowed_alerts(ticks: DataFrame, sink: str, checkpoint: str, window: str = "1 day",
                          watermark: str | None = None, trigger: dict | None = None,
                          feed: str | None = None) -> StreamingQuery:
    """Window statistics into ``sink``; runs that read the same ticks name one ``feed``."""
    run = run_id(ticks.sparkSession, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch.withColumns({"day": F.to_date("w.start"), "feed": F.lit(feed or run)}), sink, run, batch_id)

    w = (window_stats_stream(ticks, window, watermark).writeStream.outputMode("update")
         .foreachBatch(write).option("checkpointLocation", checkpoint))
    return _trigger(w, trigger).start()


class LateTicks:
    """Rows that a query's state operators dropped as late, added up as batches report them.

    A query keeps the progress of its last 100 batches only: ``look`` is called while it runs."""

    def __init__(self, query: StreamingQuery):
        self.query, self.dropped = query, {}

    def look(self) -> int:
        for p in self.query.recentProgress:
            self.dropped[p["batchId"]] = max(self.dropped.get(p["batchId"], 0),
                                             sum(op["numRowsDroppedByWatermark"] for op in p["stateOperators"]))
        return sum(self.dropped.values())


#: Seconds between two looks at a running query.
LOOK_S = 0.5


def run_to_end(query: StreamingQuery, accept_late: bool = False, timeout_s: int | None = None) -> None:
    """Wait for an ``availableNow`` query to drain; raise its error if it failed, or if it lost late ticks."""
    late, started = LateTicks(query), time.monotonic()
    while not query.awaitTermination(LOOK_S):
        late.look()
        if timeout_s is not None and time.monotonic() - started > timeout_s:
            query.stop()
            raise TimeoutError(f"streaming query did not finish in {timeout_s} s")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    if late.look() and not accept_late:
        raise LateTicksError(f"{late.look()} partial aggregates came after the watermark and were dropped")


def read_alerts(spark: SparkSession, sink: str) -> DataFrame:
    """Alerts of all runs and batches of a micro-batch sink; none before its first alert."""
    return read_compacted(spark, sink, ALERTS)


def merged_stats(parts: DataFrame) -> DataFrame:
    """(w, symbol, statistics) over the feeds of ``parts``: means and squared deviations add up by Chan's formula."""
    kept = ["n_ticks", *(c for c in STAT_COLUMNS if c != "n_ticks"), *MERGE_COLUMNS]
    rows = (parts.groupBy("w", "symbol")
            .agg(F.sum("n_ticks").alias("n_ticks"), F.max("max_price").alias("max_price"),
                 F.min("min_price").alias("min_price"), F.max_by("latest_price", "latest_at").alias("latest_price"),
                 F.sum("n_prices").alias("n"), F.sort_array(F.collect_list(F.struct(*kept))).alias("feeds")))  # one per feed

    def total(term):
        return F.aggregate(F.filter("feeds", lambda x: x["n_prices"] > 0), F.lit(0.0), lambda acc, x: acc + term(x))

    one, n = F.size("feeds") == 1, F.col("n")
    rows = rows.withColumn("avg_price", F.when(one, F.col("feeds")[0]["avg_price"])
                           .when(n > 0, total(lambda x: x["avg_price"] * x["n_prices"]) / n))
    squares = total(lambda x: F.coalesce(x["volatility"] * x["volatility"], F.lit(0.0)) * (x["n_prices"] - 1)
                    + x["n_prices"] * (x["avg_price"] - F.col("avg_price")) * (x["avg_price"] - F.col("avg_price")))
    rows = rows.withColumn("volatility", F.when(one, F.col("feeds")[0]["volatility"])
                           .when(n > 1, F.sqrt(squares / (n - 1))))
    return rows.select("w", "symbol", *STAT_COLUMNS)


def read_windowed_alerts(spark: SparkSession, sink: str) -> DataFrame:
    """The alert table over a windowed sink: every window's fullest statistics by feed, merged, then the rules."""
    return windowed_alerts(read_compacted(spark, sink, WINDOW_STATS))


def fullest(rows: DataFrame) -> DataFrame:
    """The fullest statistics of each (feed, window, symbol): what later batches of a window supersede goes."""
    kept = [f.name for f in WINDOW_STATS.fields if f.name not in ("feed", "w", "symbol")]
    return (rows.groupBy("feed", "w", "symbol").agg(F.max_by(F.struct(*kept), F.col("n_ticks")).alias("s"))
            .select("w", "symbol", "feed", "s.*").select(*WINDOW_STATS.fieldNames()))


def windowed_alerts(rows: DataFrame) -> DataFrame:
    """The alert table over rows of a windowed sink."""
    by_feed = fullest(rows).select("w", "symbol", *STAT_COLUMNS, *MERGE_COLUMNS)
    once = by_feed.dropDuplicates(["w", "symbol", "n_ticks", "ticks_hash"])
    return to_alert_table(alert_rows(merged_stats(once), ["w", "symbol"]))
