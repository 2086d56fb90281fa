"""Training-order materialisation: token sequences under a keyed permutation, in fixed-stride shards.

Documents become token ids with an end id and are cut into sequences of at most
``length`` ids.  The tokenised sequences are written once; a sequence's number is
its place in that table.  A keyed Feistel network over the next even number of
bits, walked along its cycle until it falls below the number of sequences, gives
each number its own slot: a permutation that needs no sort and no shared state.
Sequences are dealt by ranges of slots, one range a task and of equal size since
slots are dense, and each range writes its shards: a shard holds ``slots``
consecutive slots of ``2 * length`` bytes each, so a reader finds slot s at shard
s // slots, byte s % slots * stride, and goes on from any slot.  A manifest beside
the shards states the key, the number of sequences, the stride and each shard's
size and checksum; ``broken`` holds the shards against it.

Defined results: null text counts as empty (the end id alone); repeated rows are
sequences of their own; an empty table gives no shards; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlens.llm.common import stored, text_or_empty
from marketlens.llm.packing import END_ID, WordIds
from marketlens.session import scratch_dir

LENGTH, SLOTS, KEY, PAD_ID = 1024, 128, 20_240_601, 0
ROUNDS = 6
#: Rows of sequences that a task handles or passes on at once; words that it remembers while tokenising.
ROWS_OUT, REMEMBERED = 1000, 150_000

SEQUENCES = "part int, nth long, doc_id long, start long, n int, ids binary"
SHARDS = ("shard long, first_slot long, doc_ids array<long>, starts array<long>, lengths array<int>, "
          "payload binary, crc32 long")
#: One row per shard; the first four columns are those of the whole output.
MANIFEST = ("key string, total long, stride int, slots int, shard long, first_slot long, n_slots int, n_bytes long, "
            "crc32 long")


def _mixed(x: np.ndarray, key: int) -> np.ndarray:
    """A 64-bit mix of x and key (multiply, shift and xor)."""
    with np.errstate(over="ignore"):
        x = x ^ np.uint64(key & (1 << 64) - 1)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ x >> np.uint64(shift)) * np.uint64(factor)
        return x ^ x >> np.uint64(31)


def slots_of(numbers: np.ndarray, total: int, key: int, back: bool = False) -> np.ndarray:
    """The slot of each number below ``total`` (with ``back``, the number of each slot)."""
    half = max(1, -(-(max(total, 2) - 1).bit_length() // 2))
    mask = np.uint64((1 << half) - 1)
    out = np.asarray(numbers).astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for r in (range(ROUNDS - 1, -1, -1) if back else range(ROUNDS)):
            if back:
                left, right = right ^ _mixed(left, key * 0x9E3779B97F4A7C15 + r) & mask, left
            else:
                left, right = right, left ^ _mixed(right, key * 0x9E3779B97F4A7C15 + r) & mask
        out[todo] = left << np.uint64(half) | right
        todo = todo[out[todo] >= total]
    return out.astype(np.int64)


def _cut(path: str, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part, nth, rows = WordIds.of(path, REMEMBERED), TaskContext.get().partitionId(), 0, []
        end = np.array([END_ID], "<u2").tobytes()
        names = [x.split()[0] for x in SEQUENCES.split(", ")]

        def out():
            cols = list(zip(*rows))
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.frombuffer(words.encode(text.as_py()), "<u4")
                if len(ids) and ids.max() > 0xFFFF:
                    raise ValueError("ids beyond 16 bits")
                raw = ids.astype("<u2").tobytes() + end
                for a in range(0, len(raw), 2 * length):
                    piece = raw[a:a + 2 * length]
                    rows.append((part, nth, doc, a // 2, len(piece) // 2, piece))
                    nth += 1
                if len(rows) >= ROWS_OUT:
                    yield out()
                    rows.clear()
        if rows:
            yield out()

    return run


def _slotted(total: int, key: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = slots_of(batch.column(0).to_numpy(), total, key)
            yield pa.RecordBatch.from_arrays([pa.array(slot), *batch.columns[1:]],
                                             names=["slot", *batch.schema.names[1:]])

    return run


def _sharded(slots: int, stride: int):
    """Rows sorted by slot, whole shards in one task -> one row per shard."""
    pad = np.array([PAD_ID], "<u2").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def out():
            first = held[0][0]
            payload = b"".join(ids + pad * ((stride - len(ids)) // 2) for *_, ids in held)
            docs, starts, lengths = ([[row[i] for row in held]] for i in (1, 2, 3))
            return pa.RecordBatch.from_arrays(
                [pa.array([at], pa.int64()), pa.array([first], pa.int64()), pa.array(docs, pa.list_(pa.int64())),
                 pa.array(starts, pa.list_(pa.int64())), pa.array(lengths, pa.list_(pa.int32())),
                 pa.array([payload], pa.binary()), pa.array([zlib.crc32(payload)], pa.int64())],
                names=[x.split()[0] for x in SHARDS.split(", ")])

        for batch in batches:
            for k in range(0, batch.num_rows, ROWS_OUT):
                for row in zip(*(c.to_pylist() for c in batch.slice(k, ROWS_OUT).columns)):
                    if row[0] // slots != at:
                        if held:
                            yield out()
                        at, held = row[0] // slots, []
                    held.append(row)
        if held:
            yield out()

    return run


def materialise(docs: DataFrame, tokenizer_path: str, out_path: str, length: int = LENGTH,
                slots: int = SLOTS, key: int = KEY) -> DataFrame:
    """Write the shards to ``out_path`` and return them read back: one row per shard, payload included."""
    spark = docs.sparkSession
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    seqs = stored(d.mapInArrow(_cut(tokenizer_path, length), SEQUENCES), "sequences", "zstd")
    sizes = seqs.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # one row per writing task
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = stored(sizes.select("part", before.alias("before"), "n"), "sequence_starts")
    total = starts.agg(F.sum("n")).first()[0] or 0
    numbered = (seqs.join(starts.select("part", "before"), "part")
                .select((F.col("before") + F.col("nth")).alias("number"), "doc_id", "start", "n", "ids"))
    slotted = numbered.mapInArrow(_slotted(total, key), "slot long, doc_id long, start long, n int, ids binary")
    # slots are dense, so equal ranges of shards are equal in size without sampling
    shards = -(-total // slots) or 1
    tasks = min(shards, max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    nth = F.floor(F.floor(F.col("slot") / slots) * tasks / shards).cast("int")
    (slotted.repartitionById(tasks, nth).sortWithinPartitions("slot").select("slot", "doc_id", "start", "n", "ids")
     .mapInArrow(_sharded(slots, 2 * length), SHARDS).write.parquet(out_path, compression="zstd"))
    written = spark.read.schema(SHARDS).parquet(out_path)
    (written.select(F.lit(str(key)).alias("key"), F.lit(total).cast("long").alias("total"),
                    F.lit(2 * length).alias("stride"), F.lit(slots).alias("slots"), "shard", "first_slot",
                    F.size("lengths").alias("n_slots"), (F.size("lengths") * F.lit(2 * length)).cast("long").alias("n_bytes"),
                    "crc32").write.parquet(_manifest_path(out_path)))
    return written


def _manifest_path(path: str) -> str:
    return f"{path.rstrip('/')}/_manifest"


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per shard: key, total, stride, slots, shard, first_slot, n_slots, n_bytes, crc32."""
    return spark.read.schema(MANIFEST).parquet(_manifest_path(path))


def broken(spark: SparkSession, path: str) -> DataFrame:
    """(shard, n_bytes, crc32) of the manifest whose shard is missing or has other bytes."""
    have = spark.read.schema(SHARDS).parquet(path).select(
        F.col("shard").alias("have"), F.length("payload").alias("size"), F.crc32("payload").alias("sum"))
    want = manifest(spark, path).select("shard", "n_bytes", "crc32")
    same = (F.col("shard") == F.col("have")) & (F.col("n_bytes") == F.col("size")) & (F.col("crc32") == F.col("sum"))
    return want.join(have, same, "left_anti")


def read_from(spark: SparkSession, path: str, slot: int = 0, n: int | None = None,
              length: int = LENGTH, slots: int = SLOTS) -> DataFrame:
    """(slot, doc_id, start, n, ids): the sequences from ``slot`` on, at most ``n``; only their shards are read."""
    last = None if n is None else slot + n - 1
    shards = spark.read.schema(SHARDS).parquet(path).filter(F.col("shard") >= slot // slots)
    if last is not None:
        shards = shards.filter(F.col("shard") <= last // slots)
    rows = sequences(shards, length).filter(F.col("slot") >= slot)
    return rows if last is None else rows.filter(F.col("slot") <= last)


def sequences(shards: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per slot of ``shards``, its ids cut from the payload by the stride."""
    rows = shards.select("shard", "first_slot", "payload",
                         F.posexplode(F.arrays_zip("doc_ids", "starts", "lengths")).alias("i", "s"))
    ids = F.substring(F.col("payload"), F.col("i") * (2 * length) + 1, F.col("s.lengths") * 2)
    return rows.select((F.col("first_slot") + F.col("i")).alias("slot"), "shard",
                       (F.col("i") * (2 * length)).cast("long").alias("byte_offset"), F.col("s.doc_ids").alias("doc_id"),
                       F.col("s.starts").alias("start"), F.col("s.lengths").alias("n"), ids.alias("ids"))


def report(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """One row per sequence, read from the shards: slot, shard, byte_offset, doc_id, start, n, ids_crc32."""
    path = scratch_dir(docs.sparkSession, "training_shards")
    shards = materialise(docs, tokenizer_path, path)
    return sequences(shards).select("slot", "shard", "byte_offset", "doc_id", "start", F.col("n").cast("long").alias("n"),
                                    F.crc32("ids").alias("ids_crc32"))
