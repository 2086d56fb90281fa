"""Tick message codecs and sources.

Messages are JSON: ``{"symbol", "price", "prev_price", "change_pct", "volume",
"timestamp" (ISO-8601 with offset), "source"}``, keyed by symbol so all
ticks of a symbol land in one topic partition.  A message may carry ``seq``,
which orders ticks of one time; a Kafka tick without it takes its offset.  Parsing keeps the fields the
alert job reads and drops rows without a symbol (which also drops lines that
are not JSON at all).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.functions.scalar import pct_change, utc_instant
from marketlens.schemas import TICK_MESSAGE

# ISO-8601 with microseconds and a numeric offset, e.g. 2024-01-01T00:00:07.179575+00:00
ISO_TS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"
# Zone the encoder writes offsets in (times are UTC instants).
ENCODE_ZONE = "UTC"
# Value of the "source" field of generated messages.
SOURCE_TAG = "simulated"


def _instant(name: str) -> Column:
    # NTZ tick times are UTC wall-clock; instants are written with their offset
    return utc_instant(F.col(name))


def parse_ticks(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """JSON text (or Kafka binary ``value``) -> symbol, price, event_time (TIMESTAMP), volume, seq."""
    text = F.col(value_col).cast("string")
    seq = F.coalesce("data.seq", "offset") if "offset" in raw.columns else F.col("data.seq")
    return (raw.select(F.from_json(text, TICK_MESSAGE).alias("data"), *[c for c in ("offset",) if c in raw.columns])
               .select("data.symbol", "data.price", F.col("data.timestamp").alias("event_time"),
                       "data.volume", seq.alias("seq"))
               .filter(F.col("symbol").isNotNull()))


def encode_ticks(ticks: DataFrame) -> DataFrame:
    """Keyed messages: ``key`` = symbol, ``value`` = JSON text of the tick.

    ``ticks`` carries symbol, price, prev_price (NULL for a first tick, sent
    as the price itself), volume, event_time.
    """
    prev = F.coalesce(F.col("prev_price"), F.col("price"))
    body = F.struct(
        F.col("symbol"), F.col("price"), prev.alias("prev_price"),
        pct_change("price", prev).alias("change_pct"),
        F.col("volume"),
        _instant("event_time").alias("timestamp"),
        F.lit(SOURCE_TAG).alias("source"))
    return ticks.select(F.col("symbol").alias("key"),
                        F.to_json(body, {"timestampFormat": ISO_TS, "timeZone": ENCODE_ZONE}).alias("value"))


def ticks_as_json(ticks: DataFrame) -> DataFrame:
    """One JSON line per tick (symbol, price, volume, timestamp, and seq if there is one) in a ``value`` column."""
    more = [c for c in ("volume", "seq") if c in ticks.columns]
    body = F.struct("symbol", "price", *more, _instant("event_time").alias("timestamp"))
    return ticks.select(F.to_json(body, {"timestampFormat": ISO_TS, "timeZone": ENCODE_ZONE}).alias("value"))


def write_tick_files(ticks: DataFrame, path: str) -> str:
    """Land ticks as JSON-lines text files (input of the file stream source)."""
    ticks_as_json(ticks).write.mode("overwrite").text(path)
    return path


def read_tick_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None):
    """Streaming text source over landed tick files, parsed."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(files_per_trigger))
    return parse_ticks(reader.load(path))


def read_kafka_ticks(spark: SparkSession, servers: str, topic: str,
                     starting: str = "latest") -> DataFrame:
    """Kafka source (needs the Kafka connector on the classpath)."""
    raw = (spark.readStream.format("kafka")
           .option("kafka.bootstrap.servers", servers)
           .option("subscribe", topic)
           .option("startingOffsets", starting)
           .load())
    return parse_ticks(raw)


def write_kafka_ticks(messages: DataFrame, servers: str, topic: str) -> None:
    """Publish keyed messages with all-replica acknowledgement."""
    (messages.write.format("kafka")
     .option("kafka.bootstrap.servers", servers)
     .option("kafka.acks", "all")
     .option("topic", topic)
     .save())
