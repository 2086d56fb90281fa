"""Exact removal of 50-byte strings that an earlier document holds, with a logarithmic family of suffix arrays.

Suffixes are sampled by content: of the k-gram hashes inside every ``LENGTH``
byte window the least one, leftmost on ties, anchors the window, and a run of
windows with one anchor is one sampled suffix: the run's bytes.  Equal windows
have equal anchors, so they lie in suffixes of one anchor hash; suffixes whose
anchor no other place of the corpus has (by the second of two Bloom filters)
are left out.  Suffixes of an anchor that more than ``HOT`` places have (a header
whose surroundings differ by document) are cut into their windows, which are
dealt by their own bytes: equal windows still meet, different ones don't.

Documents come in batches by ascending doc_id.  A batch's suffixes, dealt by
anchor hash to shards, are sorted there into the batch's suffix array and scanned
together with the arrays of the existing levels: windows equal to one of a
smaller doc_id mark their bytes.  Then the batch becomes a level, and levels of
equal size merge, so n batches leave at most log2(n) + 1 levels.  The last batch
of a run needn't be added (``report`` doesn't).

Within a task equal suffixes travel once, for the smallest doc_id; the others are
marked at once, so a passage that a third of all documents hold meets as one
suffix per task.  Windows are compared by a 128-bit hash within an anchor.

Defined results: null text counts as empty; null doc_id comes after all others;
rows with one doc_id are one document and never mark each other; repeated rows
give repeated rows; an empty table gives no rows; extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructType

from marketlens.llm import repeats
from marketlens.llm.common import free_name, slices, stored, text_or_empty, through_arrow

LENGTH, GRAM = 50, 16
#: k-gram hashes in one window, and the share of positions that become suffixes.
IN_WINDOW = LENGTH - GRAM + 1
SAMPLED = 2 / (IN_WINDOW + 1)
BATCHES = 3
FILTER_BITS_EACH, MAX_FILTER_BITS = 8, 1 << 29
#: Bytes of text hashed at once, so few that the hashes stay in a core's cache; bytes of text whose suffixes are
#: passed on together; text per shard.
BLOCK, FLUSH, SHARD = 1 << 16, 16 << 20, 2 << 20
#: Suffixes of one anchor beyond which they are dealt by window; about 2 MB of text.
HOT = 1 << 15
LAST = (1 << 63) - 1

#: What a row's suffixes are in a scan: of the batch, of a level that merges with it, of another level.
FRESH, MERGED, SCANNED = 0, 1, 2
#: What travels: marks of a document, or a blob of suffixes of a shard.
ROWS = "shard int, doc long, rk long, spans array<long>, blob binary"
SUFFIXES = pa.schema([("doc", pa.int64()), ("rk", pa.int64()), ("at", pa.int32()), ("text", pa.binary())])
ZSTD = pa.ipc.IpcWriteOptions(compression="zstd")


def _mixed(x: np.ndarray) -> np.ndarray:
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    return x


def gram_hashes(raw: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """A hash of the ``size`` bytes from every position on, a block of positions at a time."""
    n = len(raw) - size + 1
    if n <= BLOCK:
        return _block_hashes(raw, size, seed)
    out = np.empty(n, np.uint64)
    for k in range(0, n, BLOCK):
        out[k:k + BLOCK] = _block_hashes(raw[k:k + BLOCK + size - 1], size, seed)
    return out


def _block_hashes(raw: np.ndarray, size: int, seed: int) -> np.ndarray:
    """The same of one block, by doubling."""
    table = np.random.default_rng(seed).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    factor = np.uint64(0x9E3779B97F4A7C15 + 2 * seed)
    power, have, whole, done = table[raw], 1, None, 0
    while True:
        if size & have:
            if whole is None:
                whole, done = power, have
            else:
                n = len(raw) - done - have + 1
                whole, done = _mixed(whole[:n] * factor ^ power[done:done + n]), done + have
        if 2 * have > size:
            return whole
        n = len(raw) - 2 * have + 1
        power, have = _mixed(power[:n] * factor ^ power[have:have + n]), 2 * have


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` neighbours."""
    n, have = len(x) - width + 1, 1
    while 2 * have <= width:
        x, have = np.minimum(x[:-have], x[have:]), 2 * have
    return np.minimum(x[:n], x[width - have:width - have + n])


def suffixes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sampled suffixes of ``texts``: (text number, first window, windows, anchor hash).

    One run may go on with the same hash at a later anchor; that changes nothing.
    """
    sizes = np.array([len(t) for t in texts])
    raw = np.frombuffer(b"".join(texts), np.uint8)
    if len(raw) < LENGTH:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    least = _least(gram_hashes(raw, GRAM), IN_WINDOW)
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(texts)), sizes)
    windows = owner[:len(least)] == owner[LENGTH - 1:]  # a window never crosses texts
    at = np.flatnonzero(windows)
    first = at[np.r_[True, (np.diff(at) > 1) | (least[at[1:]] != least[at[:-1]])]] if len(at) else at
    # runs are at most IN_WINDOW windows long, whatever the text repeats
    edge = np.searchsorted(at, first)
    n = np.diff(np.r_[edge, len(at)])
    pieces = -(-n // IN_WINDOW)
    nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = np.repeat(first, pieces) + nth * IN_WINDOW
    n = np.minimum(np.repeat(n, pieces) - nth * IN_WINDOW, IN_WINDOW)
    own = owner[first]
    return own, first - starts[own], n, least[first]


def _blocks(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts) of about BLOCK bytes each."""
    first, held, size = 0, [], 0
    for i, text in enumerate(batch.column(column)):
        held.append(text.as_buffer().to_pybytes())
        size += len(held[-1])
        if size >= BLOCK:
            yield first, held
            first, held, size = i + 1, [], 0
    if held:
        yield first, held


def _anchor_hashes(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for _, texts in _blocks(batch, 0):
        own, _, _, anchor = suffixes(texts)
        order = np.lexsort((anchor, own))
        own, anchor = own[order], anchor[order]
        if len(own):
            new = np.r_[True, (own[1:] != own[:-1]) | (anchor[1:] != anchor[:-1])]
            yield anchor[new], anchor[~new]


def _packed(columns: Iterable) -> bytes:
    batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, SUFFIXES)], schema=SUFFIXES)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, SUFFIXES, options=ZSTD) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(blob).read_all()


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted, disjoint, not touching."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _sent(marks: dict[tuple[int, int], list[tuple[int, int]]], blobs: dict[int, Iterable], shards: int) -> pa.RecordBatch:
    docs, rks, spans, names = [], [], [], []
    for (doc, rk), found in marks.items():
        docs.append(doc)
        rks.append(rk)
        spans.append([x for span in merged(found) for x in span])
        names.append((doc ^ rk) % shards)
    n, k = len(docs), len(blobs)
    return pa.RecordBatch.from_arrays(
        [pa.array(names + list(blobs), pa.int32()), pa.array(docs + [None] * k, pa.int64()),
         pa.array(rks + [None] * k, pa.int64()), pa.array(spans + [None] * k, pa.list_(pa.int64())),
         pa.array([None] * n + [_packed(columns) for columns in blobs.values()], pa.binary())],
        names=[x.split()[0] for x in ROWS.split(", ")])


def _suspects(found, shards: int):
    """Documents (doc, rk, text) -> marks of what the same task resolves, and blobs of suspected suffixes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first_doc: dict[bytes, int] = {}
        first_window: dict[bytes, int] = {}
        marks, blobs, size = {}, {}, 0
        for batch in slices(batches):
            batch = batch.take(pa.compute.sort_indices(batch.column(0)))
            docs, rks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for first_row, texts in _blocks(batch, 2):
                own, at, n, anchor = suffixes(texts)
                hit = repeats.suspected(found.value, anchor)
                shard = (anchor >> np.uint64(7)) % np.uint64(shards)
                hot = repeats.crowded(found.value, anchor)
                for t, a, k, s, cut in zip(*(x[hit].tolist() for x in (own, at, n, shard, hot))):
                    row, text = first_row + t, texts[t][a:a + k + LENGTH - 1]
                    doc, rk = docs[row], rks[row]
                    if first_doc.setdefault(text, doc) < doc:
                        marks.setdefault((doc, rk), []).append((a, a + len(text)))
                    elif not cut:
                        blobs.setdefault(s, []).append((doc, rk, a, text))
                    else:
                        for i in range(k):
                            window = text[i:i + LENGTH]
                            if first_window.setdefault(window, doc) < doc:
                                marks.setdefault((doc, rk), []).append((a + i, a + i + LENGTH))
                            else:
                                s = xxhash.xxh3_64_intdigest(window) % shards
                                blobs.setdefault(s, []).append((doc, rk, a + i, window))
                        size += k * IN_WINDOW // 2  # as many windows as suffixes of so much text
                size += sum(map(len, texts))
                if size >= FLUSH:
                    yield _sent(marks, {s: zip(*rows) for s, rows in blobs.items()}, shards)
                    first_doc, first_window, marks, blobs, size = {}, {}, {}, {}, 0
        if marks or blobs:
            yield _sent(marks, {s: zip(*rows) for s, rows in blobs.items()}, shards)

    return run


def scan(array: pa.Table, fresh: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(doc, rk, from, to) of the fresh suffixes' bytes that windows of smaller documents cover."""
    texts = array["text"].combine_chunks()
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(texts.buffers()[2], np.uint8) if ends[-1] else np.empty(0, np.uint8)
    n = np.diff(ends) - LENGTH + 1
    entry = np.repeat(np.arange(len(n)), n)
    nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    at = ends[entry] + nth
    doc = array["doc"].to_numpy()[entry]
    a, b = (gram_hashes(raw, LENGTH, seed)[at] for seed in (1, 2))
    order = np.argsort(a)
    if (apart := (a[order[1:]] == a[order[:-1]]) & (b[order[1:]] != b[order[:-1]])).any():
        order = np.lexsort((b, a))  # two strings with one first hash: tell them apart
    del apart
    a, b, doc = a[order], b[order], doc[order]
    head = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
    least = np.minimum.reduceat(doc, np.flatnonzero(head))[np.cumsum(head) - 1]
    found = np.zeros(len(order), bool)
    found[order] = doc > least
    hit = np.flatnonzero(found & fresh[entry])
    if not len(hit):
        return []
    start = np.r_[True, (np.diff(hit) > 1) | (entry[hit[1:]] != entry[hit[:-1]])]
    first, last = hit[start], hit[np.r_[start[1:], True]]
    e = entry[first]
    place = array["at"].to_numpy()[e]
    return list(zip(array["doc"].to_numpy()[e].tolist(), array["rk"].to_numpy()[e].tolist(),
                    (place + nth[first]).tolist(), (place + nth[last] + LENGTH).tolist()))


def _scanned(add: bool, shards: int):
    """Rows sorted by shard -> marks, and if ``add`` the blobs of the level that batch and merged levels become."""
    def done(shard: int, blobs: list[tuple[int, bytes]]) -> pa.RecordBatch:
        tables = [_unpacked(blob) for _, blob in blobs]
        role = np.concatenate([np.full(len(t), r) for t, (r, _) in zip(tables, blobs)])
        array = pa.concat_tables(tables).combine_chunks()
        marks: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for doc, rk, a, b in scan(array, role == FRESH):
            marks.setdefault((doc, rk), []).append((a, b))
        level = {}
        if add and (role != SCANNED).any():
            # a suffix array: sorted, equal suffixes once, for the smallest document
            own = array.filter(pa.array(role != SCANNED)).sort_by([("text", "ascending"), ("doc", "ascending")])
            text = own["text"].combine_chunks()
            new = np.r_[True, pa.compute.not_equal(text[1:], text[:-1]).to_numpy(zero_copy_only=False)]
            own = own.filter(pa.array(new)).combine_chunks()
            zeros = np.zeros(len(own), np.int64)
            level[shard] = own["doc"].combine_chunks(), zeros, zeros.astype(np.int32), own["text"].combine_chunks()
        return _sent(marks, level, shards)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            marks = batch.column("blob").is_null()
            yield batch.filter(marks).select([x.split()[0] for x in ROWS.split(", ")])
            rest = batch.filter(pa.compute.invert(marks))
            for shard, role, blob in zip(*(rest.column(c).to_pylist() for c in ("shard", "role", "blob"))):
                if shard != at:
                    if held:
                        yield done(at, held)
                    at, held = shard, []
                held.append((role, blob))
        if held:
            yield done(at, held)

    return run


class IndexFamily:
    """Levels of suffix arrays over the batches added so far; batches must come by ascending doc."""

    def __init__(self, spark: SparkSession, found, shards: int):
        self.spark, self.found, self.shards = spark, found, shards
        self.levels: list[tuple[int, DataFrame]] = []  # (batches in it, rows), oldest first

    def add(self, batch: DataFrame, last: bool = False) -> DataFrame:
        """Scan a batch (doc, rk, text) against itself and all levels: its marks (doc, rk, spans).

        Unless it is the ``last`` one it becomes a level of size one and merges with
        levels of equal size, in the pass that scans them.
        """
        size, stay = 1, list(self.levels)
        merging = []
        while not last and stay and stay[-1][0] == size:
            merging.append(stay.pop()[1])
            size *= 2
        rows = batch.mapInArrow(_suspects(self.found, self.shards), ROWS).withColumn("role", F.lit(FRESH))
        for level in merging:
            rows = rows.union(level.withColumn("role", F.lit(MERGED)))
        for _, level in stay:
            rows = rows.union(level.withColumn("role", F.lit(SCANNED)))
        n = min(self.shards, int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        dealt = rows.repartition(max(1, n), "shard").sortWithinPartitions("shard")
        out = stored(dealt.mapInArrow(_scanned(not last, self.shards), ROWS), "suffix_level", freed=True)
        if not last:
            self.levels = [*stay, (size, out.filter(F.col("blob").isNotNull()))]
        return out.filter(F.col("blob").isNull()).select("doc", "rk", "spans")


def _removed(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            k = batch.num_columns - 2
            size, gone, n, kept = [], [], [], []
            for text, spans in zip(batch.column(k), batch.column(k + 1)):
                text = text.as_py()
                flat = [x for part in spans.as_py() or () for x in part]
                found = merged(list(zip(flat[::2], flat[1::2])))
                out, at = [], 0
                for a, b in found:
                    out.append(text[at:a])
                    at = b
                out.append(text[at:])
                size.append(len(text))
                gone.append(sum(b - a for a, b in found))
                n.append(len(found))
                kept.append(b"".join(out))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:k], pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(n, pa.int64()),
                 pa.array(kept, pa.binary())], names=names)

    return run


def marks(texts: DataFrame, batches: int = BATCHES) -> DataFrame:
    """(doc, rk, spans) of ``texts`` (doc, rk, text as binary): flat byte spans to remove; a document may have several rows."""
    spark = texts.sparkSession
    shares = F.array(*[F.lit(i / batches) for i in range(1, batches)] or [F.lit(1.0)])
    size, cuts = texts.agg(F.sum(F.length("text")), F.percentile_approx("doc", shares, 1000)).first()
    size, cuts = size or 0, sorted(set(cuts or ())) if batches > 1 else []
    found = repeats.seen_twice(texts.select("text"), _anchor_hashes,
                               repeats.filter_bits(int(size * SAMPLED), FILTER_BITS_EACH, MAX_FILTER_BITS), HOT, freed=True)
    family = IndexFamily(spark, found, max(1, size // SHARD))
    out = None
    for low, high in zip([None, *cuts], [*cuts, None]):
        batch = texts
        if low is not None:
            batch = batch.filter(F.col("doc") > low)
        if high is not None:
            batch = batch.filter(F.col("doc") <= high)
        found_here = family.add(batch, last=high is None)
        out = found_here if out is None else out.union(found_here)
    return out


def dedup(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with four more columns: bytes, bytes removed, removed runs, and the bytes that stay (binary).

    The second result maps "n_bytes", "n_removed", "n_spans" and "kept" to their names.
    """
    doc, rk = (free_name(docs, f"suffix_{c}") for c in ("doc", "rk"))
    keyed = docs.withColumns({doc: F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)), rk: F.xxhash64(text_or_empty())})
    raw = text_or_empty().cast("binary")
    texts = keyed.select(F.col(doc).alias("doc"), F.col(rk).alias("rk"), raw.alias("text"))
    spans = free_name(keyed, "suffix_spans")
    found = (marks(texts).groupBy("doc", "rk").agg(F.collect_list("spans").alias(spans))
             .withColumnsRenamed({"doc": doc, "rk": rk}))
    # the bytes are made after the join, which would move a text twice
    joined = (keyed.join(found, [doc, rk], "left")
              .select(*[F.col(f"`{c}`") for c in docs.columns], raw.alias(free_name(keyed, "suffix_text")), spans))
    names = {c: free_name(docs, f"suffix_{c}") for c in ("n_bytes", "n_removed", "n_spans", "kept")}
    schema = StructType([*docs.schema.fields])
    for c in ("n_bytes", "n_removed", "n_spans"):
        schema = schema.add(names[c], LongType())
    schema = schema.add(names["kept"], BinaryType())
    return through_arrow(joined, _removed(schema.names), schema), names


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    d, names = dedup(docs.select("doc_id", "text"))
    return d.select("doc_id", *[F.col(names[c]).alias(c) for c in ("n_bytes", "n_removed", "n_spans")],
                    F.sha2(F.col(names["kept"]), 256).alias("kept_sha256"))


def keep(docs: DataFrame) -> DataFrame:
    """The documents without the removed bytes; a character that lost some of its bytes becomes U+FFFD."""
    d, names = dedup(docs)
    kept = F.col(names["kept"])
    text = F.make_valid_utf8(kept.cast("string"))
    out = [text.alias(c) if c == "text" else F.char_length(text).cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
           else F.col(f"`{c}`") for c in docs.columns]
    return d.select(*out)
