"""SimHash near-dedup by multi-index hashing.

A document's fingerprint is the bitwise majority of its shingles' XXH64.
Distinct fingerprints are cut into three segments; two that differ in at most
four bits agree up to one bit in the first or second segment or agree in the
third.  So every fingerprint enumerates the Hamming balls of radius 1, 1 and 0
around its segments, these values are looked up among the segments of all
fingerprints, and matches are verified by their whole distance.

A looked-up value's fingerprints never become all their pairs: small groups are
compared by shifts of the sorted rows, groups beyond ``SMALL`` by a search that
drops every fingerprint once reached, and either passes on a spanning forest of
the verified links.  Values of more than ``HOT`` fingerprints are first split by
the same scheme on other bits, which loses no link.

Defined results: null or wordless text has fingerprint zero and links like any
other; null doc_id takes its group's component, null if no member has an id;
repeated rows give repeated rows; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import free_name, stored, text_or_empty
from marketlens.llm.components import Forest, components

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
#: (first bit, bits, radius): radii plus one sum to MAX_BITS + 1, so no link is missed.
SEGMENTS = ((0, 21, 1), (21, 21, 1), (42, 22, 0))
#: Rows of one looked-up value that are compared by shifts; larger groups by search.
SMALL = 64
#: Fingerprints under one segment value beyond which it is split further.
HOT = 50_000


def fingerprint(text: str, size: int = SHINGLE_WORDS) -> int:
    words = text.encode().lower().split()  # bytes: ASCII letters and ASCII white space only
    if not words:
        return 0
    if len(words) <= size:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        joined, digest = b" ".join(words), xxhash.xxh64_intdigest
        ends = list(accumulate(map(len, words)))
        ends = [e + i for i, e in enumerate(ends)]
        starts = [0, *(e + 1 for e in ends[:len(words) - size])]
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[size - 1:])]
    counts = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[k:k + (1 << 16)], "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes), bitorder="little").tobytes(), "little")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _fingerprints(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [_signed(fingerprint(t.as_py(), size)) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    return run


def _balls(radii: bool) -> Column:
    """Constant (s, first, mask, flip) of all segments: their own values, and if ``radii`` the balls around them."""
    out = []
    for s, (first, bits, radius) in enumerate(SEGMENTS):
        flips = [0] + [1 << b for b in range(bits)] * (radii and radius > 0)
        out += [F.struct(F.lit(s).alias("s"), F.lit(first).alias("first"), F.lit((1 << bits) - 1).cast("long").alias("mask"),
                         F.lit(f).cast("long").alias("flip")) for f in flips]
    return F.array(*out)


def _probes(rows: DataFrame, base: Column, turn: int, radii: bool = True) -> DataFrame:
    """(key, fp, exact) of ``rows`` (fp, exact) for all segment balls; ``base`` separates the parts of a split value."""
    fp = F.col("fp")
    at = fp if turn == 0 else F.shiftleft(fp, turn).bitwiseOR(F.shiftrightunsigned(fp, 64 - turn))
    value = F.call_function("shiftrightunsigned", at, F.col("first")).bitwiseAND(F.col("mask"))
    # the array is constant: a row's probes are never objects of their own, which would fill the heap
    return (rows.select("*", F.inline(_balls(radii)))
            .select(F.xxhash64(base, "s", value.bitwiseXOR(F.col("flip"))).alias("key"), "fp",
                    (F.col("exact") & (F.col("flip") == 0)).alias("exact")))


def _search(fp: np.ndarray, exact: np.ndarray, most: int) -> list[tuple[int, int]]:
    """A spanning forest of the links within one large group."""
    links, todo = [], np.arange(len(fp))
    while len(todo):
        stack, todo = [todo[0]], todo[1:]
        while stack and len(todo):
            i = stack.pop()
            near = (np.bitwise_count(fp[todo] ^ fp[i]) <= most) & (exact[todo] | exact[i])
            reached = todo[near]
            links += [(int(i), int(j)) for j in reached]
            stack += reached.tolist()
            todo = todo[~near]
    return links


def links_within(key: np.ndarray, fp: np.ndarray, exact: np.ndarray, most: int) -> np.ndarray:
    """Links (row, row) between rows of one key, at least one of them exact; rows sorted by key."""
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    sizes = np.diff(np.r_[starts, len(key)])
    worth = (sizes > 1) & (np.add.reduceat(exact.astype(np.int64), starts) > 0)
    found = []
    for a, n in zip(starts[worth & (sizes > SMALL)], sizes[worth & (sizes > SMALL)]):
        got = _search(fp[a:a + n], exact[a:a + n], most)
        found.append(np.array(got, np.int64).reshape(-1, 2) + a)
    small = worth & (sizes <= SMALL)
    rows = np.repeat(small, sizes)
    end = np.repeat(starts + sizes, sizes)
    i = np.flatnonzero(rows)
    for step in range(1, SMALL):
        i = i[i + step < end[i]]
        if not len(i):
            break
        j = i + step
        near = (exact[i] | exact[j]) & (np.bitwise_count(fp[i] ^ fp[j]) <= most)
        found.append(np.stack([i[near], j[near]], axis=1))
    return np.concatenate(found) if found else np.empty((0, 2), np.int64)


def _linked(most: int):
    """Rows (key, fp, exact) sorted by key -> a spanning forest of links, by batch."""
    def links(key, fp, exact):
        got = links_within(key, fp.view(np.uint64), exact, most)
        forest = Forest()
        a, b = fp[got[:, 0]].tolist(), fp[got[:, 1]].tolist()
        keep = np.array([x != y and forest.union(x, y) for x, y in zip(a, b)], bool)
        got = got[keep] if len(got) else got
        return pa.RecordBatch.from_arrays([pa.array(fp[got[:, 0]]), pa.array(fp[got[:, 1]])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for batch in batches:
            cols = [batch.column(0).to_numpy(), batch.column(1).to_numpy(),
                    batch.column(2).to_numpy(zero_copy_only=False)]
            if not len(cols[0]):
                continue
            # the last key may go on in the next batch
            cut = int(np.searchsorted(cols[0], cols[0][-1]))
            if cut:
                held.append([c[:cut] for c in cols])
                yield links(*(np.concatenate(c) for c in zip(*held)))
                held = []
            held.append([c[cut:] for c in cols])
        if held:
            yield links(*(np.concatenate(c) for c in zip(*held)))

    return run


def links(fps: DataFrame, most: int = MAX_BITS, hot: int = HOT) -> DataFrame:
    """(a, b): links that connect all of ``fps`` (fp long, distinct) that differ in at most ``most`` bits."""
    if sum(r + 1 for _, _, r in SEGMENTS) <= most:
        raise ValueError(f"the segments find links of at most {sum(r + 1 for _, _, r in SEGMENTS) - 1} bits")
    own = fps.select("fp", F.lit(True).alias("exact"))
    crowded = stored(_probes(own, F.lit(0), 0, radii=False).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
                     .filter(F.col("n") > hot).select("key"), "hot_segments")
    probes = _probes(own, F.lit(0), 0)
    if not crowded.isEmpty():
        # within a split value an inexact row looks up exact ones only, as before
        split = _probes(probes.join(crowded, "key", "left_semi"), F.col("key"), 11)
        probes = probes.join(crowded, "key", "left_anti").union(split)
    rows = probes.repartition("key").sortWithinPartitions("key")
    return rows.mapInArrow(_linked(most), "a long, b long")


def _few_files(df: DataFrame, by: str) -> DataFrame:
    """``df`` in as few parts as its size asks for: on a local file system an executor starts chmod for each file it writes."""
    return df.hint("rebalance", by)


def _with_component(by_fp: DataFrame, most: int) -> DataFrame:
    """(fp, first) of distinct fingerprints, with the component of each."""
    fps = stored(by_fp, "distinct_fingerprints")
    # written first: two Python steps in one stage take two workers a core, which outlive the stage with all they load
    member = components(stored(_few_files(links(fps.select("fp"), most), "b"), "links"))
    return (fps.join(member, F.col("fp") == F.col("node"), "left")
            .select("fp", "first", F.coalesce("component", "fp").alias("component")))


def grouped(docs: DataFrame, size: int = SHINGLE_WORDS, most: int = MAX_BITS) -> DataFrame:
    """One row per document: doc_id, fingerprint, component_id."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    marked = stored(_few_files(d.mapInArrow(_fingerprints(size), "doc_id long, fp long"), "doc_id"), "fingerprints")
    first = _with_component(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), most)
    least = first.groupBy("component").agg(F.min("first").alias("component_id"))
    by_fp = first.join(least, "component").select("fp", "component_id")
    return (marked.join(by_fp, "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def _with_row_key(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with what tells rows apart, in the order they are chosen: id (nulls last), two hashes of the text."""
    doc = F.col("doc_id").cast("long")
    return docs.withColumn(key, F.struct(doc.isNull().alias("null_id"), F.coalesce(doc, F.lit(0)).alias("id"),
                                         F.xxhash64(F.lit(1), text_or_empty()).alias("h1"),
                                         F.xxhash64(F.lit(2), text_or_empty()).alias("h2")))


def _keyed_fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = [_signed(fingerprint(t.as_py())) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], names=["key", "fp"])


def keep(docs: DataFrame, null_ids_stay: bool = True) -> DataFrame:
    """One row of each component: of the least id, then of the least text hash; of equal rows any one.

    Rows without an id are members like any other, and chosen where no member has one,
    unless ``null_ids_stay``: then all of them stay and only rows with an id are chosen from.
    """
    name = free_name(docs, "kept_row")
    keyed = _with_row_key(docs, name)
    chosen_from = keyed.filter(F.col("doc_id").isNotNull()) if null_ids_stay else keyed
    key_type = keyed.schema[name].dataType.simpleString()
    marked = chosen_from.select(F.col(name).alias("key"), text_or_empty().alias("text")).mapInArrow(
        _keyed_fingerprints, f"key {key_type}, fp long")
    marked = stored(_few_files(marked, "key"), "fingerprints")
    rows = marked.groupBy("fp", "key").agg(F.count(F.lit(1)).alias("n"))
    first = _with_component(rows.groupBy("fp").agg(F.min(F.struct("key", "n")).alias("first")), MAX_BITS)
    least = stored(first.groupBy("component").agg(F.min("first").alias("first"))
                   .select(F.col("first.key").alias(name), F.col("first.n").alias("n")), "kept_rows")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    out = keyed.join(least.filter("n = 1"), name, "left_semi").select(*columns)
    repeated = least.filter("n > 1").select(name)
    if not repeated.isEmpty():
        row = F.struct(*[c.alias(f"c{i}") for i, c in enumerate(columns)])
        one = keyed.join(repeated, name, "left_semi").groupBy(name).agg(F.first(row).alias("row"))
        out = out.union(one.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)]))
    if null_ids_stay:
        out = out.union(docs.filter(F.col("doc_id").isNull()))
    return out
