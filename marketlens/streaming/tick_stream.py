"""Price changes along a stream of ticks: the previous price of a symbol is carried over micro-batches.

Each batch is one plan of built-in operators: the carried prices enter it as rows before
all others, the segmented lag of the batch operator (``operators.sequential``) finds every
tick's previous price, and the newest price per symbol is the next batch's carry.  A
symbol that holds a third of a batch is therefore spread over tasks as in batch, and
no row passes through Python.

State is one row per symbol in the run's checkpoint folder, written to two slots in
turn: batch n reads what batch n - 1 wrote and replaces what batch n - 2 wrote, so a
batch that is repeated after a failure starts from the same prices, and its output
folders are replaced.  A symbol whose last tick is more than ``idle`` older than the
newest tick seen leaves the state and starts anew.

Within a batch a symbol's ticks go by (event_time, seq); a tick that comes in a later
batch than its time follows those that were there before, as for a consumer that
compares with what it last saw.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from marketlens.functions.scalar import direction, pct_change
from marketlens.operators.alerts import MICROS_PER_HOUR, latest_key
from marketlens.operators.sequential import segmented_lag
from marketlens.sources.tables import read_or_empty
from marketlens.streaming.alerts_stream import run_id, write_batch

_TICK = (StructType().add("symbol", "string").add("event_time", "timestamp").add("seq", "long").add("price", "double")
         .add("volume", "long"))
#: A carried price: the batch that wrote it, and the newest time of its symbol.
STATE = StructType().add("symbol", "string").add("price", "double").add("seen", "timestamp").add("batch_id", "long")
#: The stored stream: changes, and the folders that lay it out.
CHANGES = (StructType([*_TICK.fields]).add("prev_price", "double").add("change_pct", "double").add("direction", "string")
           .add("day", "date").add("run_id", "string").add("batch_id", "long"))


def _slot(checkpoint: str, batch_id: int) -> str:
    return f"{checkpoint.rstrip('/')}/prices/slot={batch_id % 2}"


def read_state(spark: SparkSession, checkpoint: str, batch_id: int) -> DataFrame:
    """The prices that batch ``batch_id`` left; none before the first batch."""
    return read_or_empty(spark, _slot(checkpoint, batch_id), STATE).filter(F.col("batch_id") == batch_id)


def batch_changes(batch: DataFrame, carried: DataFrame, segment_micros: int = MICROS_PER_HOUR) -> DataFrame:
    """The batch's ticks with ``prev_price``, percent change and direction."""
    first = carried.select("symbol", F.lit(None).cast("timestamp").alias("event_time"), F.lit(None).cast("long").alias("seq"),
                           "price", F.lit(None).cast("long").alias("volume"), F.lit(False).alias("_new"))
    rows = first.unionByName(batch.withColumn("_new", F.lit(True)))
    # carried rows have no time, hence the first segment, and come first there
    segment = F.floor(F.unix_micros("event_time") / F.lit(segment_micros))
    lagged = segmented_lag(rows, "symbol", ["_new", "event_time", "seq"], "price", segment, "prev_price")
    return lagged.filter("_new").select(
        *[f.name for f in _TICK.fields], "prev_price", pct_change("price", "prev_price").alias("change_pct"),
        direction("price", "prev_price").alias("direction"), F.to_date("event_time").alias("day"))


def next_state(batch: DataFrame, carried: DataFrame, batch_id: int, idle: timedelta) -> DataFrame:
    """One row per symbol: the price of its last tick, without the symbols that have been idle."""
    newest = F.max_by(F.struct("price"), latest_key(batch))
    now = (batch.groupBy("symbol").agg(newest.alias("last"), F.max("event_time").alias("seen"))
           .select("symbol", "last.price", "seen", F.lit(1).alias("turn")))
    both = now.unionByName(carried.select("symbol", "price", "seen", F.lit(0).alias("turn")))
    rows = both.groupBy("symbol").agg(F.max_by(F.struct("price"), "turn").alias("last"), F.max("seen").alias("seen"))
    latest = both.agg(F.max("seen")).scalar()
    awake = F.col("seen").isNull() | (F.unix_micros("seen") >= F.unix_micros(latest) - int(idle.total_seconds() * 1_000_000))
    return rows.filter(awake).select("symbol", "last.price", "seen", F.lit(batch_id).cast("long").alias("batch_id"))


def change_writer(sink: str, checkpoint: str, run: str, idle: timedelta):
    """``foreachBatch`` callback: the batch's changes into its folders, then its state into its slot."""
    def write(batch: DataFrame, batch_id: int) -> None:
        ticks = batch.filter(F.col("symbol").isNotNull()).select(*[f.name for f in _TICK.fields]).persist()
        try:
            carried = read_state(batch.sparkSession, checkpoint, batch_id - 1)
            write_batch(batch_changes(ticks, carried), sink, run, batch_id)
            (next_state(ticks, carried, batch_id, idle).write.mode("overwrite").parquet(_slot(checkpoint, batch_id)))
        finally:
            ticks.unpersist()

    return write


def start_changes(ticks: DataFrame, sink: str, checkpoint: str, idle: timedelta = timedelta(days=7),
                  trigger: dict | None = None) -> StreamingQuery:
    """Price changes of a tick stream into ``sink``; a restart on the same checkpoint goes on from its prices."""
    run = run_id(ticks.sparkSession, checkpoint)
    return (ticks.writeStream.foreachBatch(change_writer(sink, checkpoint, run, idle)).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def read_changes(spark: SparkSession, sink: str) -> DataFrame:
    return read_or_empty(spark, sink, CHANGES)
