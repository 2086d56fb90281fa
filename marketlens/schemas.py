"""Schemas of the datasets the library reads and writes."""

from pyspark.sql.types import (
    DateType, DoubleType, LongType, StringType, StructField, StructType,
    TimestampNTZType, TimestampType,
)

# Raw daily bar as loaded into the raw table.
RAW_BARS = StructType([
    StructField("date", DateType()),
    StructField("open", DoubleType()),
    StructField("high", DoubleType()),
    StructField("low", DoubleType()),
    StructField("close", DoubleType()),
    StructField("volume", LongType()),
    StructField("symbol", StringType()),
    StructField("ingested_at", TimestampNTZType()),
])

# Landing file as written by the ingest step: the bar date is epoch
# nanoseconds and the ingest time an ISO-8601 string.
LANDING_BARS = StructType([
    StructField("date", LongType()),
    StructField("open", DoubleType()),
    StructField("high", DoubleType()),
    StructField("low", DoubleType()),
    StructField("close", DoubleType()),
    StructField("volume", LongType()),
    StructField("symbol", StringType()),
    StructField("ingested_at", StringType()),
])

# Tick message fields read by the consumer.  The timestamp is parsed as a
# real timestamp (ISO-8601 with or without offset), not as a long.
TICK_MESSAGE = StructType([
    StructField("symbol", StringType()),
    StructField("price", DoubleType()),
    StructField("volume", LongType()),
    StructField("timestamp", TimestampType()),
    StructField("seq", LongType()),
])
