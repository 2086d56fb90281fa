"""Two Bloom filters over a corpus: which hashes were seen once, and which twice.

Tasks pass on the distinct hashes of their documents, packed by chunk (the top
bits); each chunk's slice of both filters is filled in one place, rows streaming
by.  A hash whose bits are all set in "once" goes into "twice", so "twice" holds
every hash of two documents, and some more.

Where asked for, hashes are counted on the way: a task passes on how often it
holds a hash beyond once, so the sum of a chunk misses at most one a pack.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from marketlens.llm.common import stored

CHUNK_BITS = 1 << 18
MIN_BITS = 1 << 20
#: Hashes that a task holds before it passes them on.
HELD = 1 << 20
#: Bytes of a hash that travel: two bit numbers of 18 bits.
SENT = 5
NONE = np.empty(0, np.uint64)


class Seen(NamedTuple):
    """The second filter by chunk, and the sorted names of the hashes that occur too often."""

    twice: np.ndarray
    hot: np.ndarray


def filter_bits(expected: int, bits_each: int, most: int) -> int:
    return min(most, max(MIN_BITS, 1 << (expected * bits_each).bit_length()))


def _chunk(h: np.ndarray, chunks: int) -> np.ndarray:
    return (h >> np.uint64(40)).astype(np.int64) % chunks


def _bits(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = np.uint64(CHUNK_BITS - 1)
    return (h & low).astype(np.int64), (h >> np.uint64(18) & low).astype(np.int64)


def _names(h: np.ndarray, chunks: int) -> np.ndarray:
    """A hash as the filled chunks know it: its chunk and two bit numbers."""
    return (_chunk(h, chunks).astype(np.uint64) << np.uint64(36)) | (h & np.uint64((1 << 36) - 1))


def _dealt(hashes: Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, np.ndarray]]], chunks: int, counted: bool):
    def by_chunk(h: np.ndarray, rows: np.ndarray) -> tuple[list[int], list[bytes]]:
        chunk = _chunk(h, chunks)
        order = np.argsort(chunk, kind="stable")
        chunk = chunk[order]
        cut = np.flatnonzero(np.diff(chunk)) + 1
        parts = np.split(np.ascontiguousarray(rows[order]), cut)
        return chunk[np.r_[0, cut]].tolist(), [p.tobytes() for p in parts]

    def pack(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        # a hash twice in a task stays twice: that alone puts it into the second filter
        h, n = np.unique(np.concatenate([x for x, _ in held]), return_counts=True)
        twice = np.concatenate([h, h[n > 1]])
        names, sent = by_chunk(twice, twice.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :SENT])
        counts = [None] * len(names)
        if counted:
            more, m = np.unique(np.concatenate([x for _, x in held]), return_counts=True)
            more, m = np.concatenate([h[n > 1], more]), np.concatenate([n[n > 1], m])
            if len(more):
                at, blobs = by_chunk(more, np.stack([more, m.astype(np.uint64)], axis=1))
                names, sent, counts = names + at, sent + [None] * len(at), counts + blobs
        return pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(sent, pa.binary()),
                                           pa.array(counts, pa.binary())], names=["chunk", "hashes", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for h in hashes(batch):
                held.append(h)
                n += len(h[0]) + len(h[1])
                if n >= HELD:
                    yield pack(held)
                    held, n = [], 0
        if n:
            yield pack(held)

    return run


def _summed(held: list[np.ndarray]) -> np.ndarray:
    """(hash, count) rows with each hash once."""
    rows = np.concatenate(held)
    h, at = np.unique(rows[:, 0], return_inverse=True)
    n = np.zeros(len(h), np.uint64)
    np.add.at(n, at, rows[:, 1])
    return np.stack([h, n], axis=1)


def _filled(chunks: int, most: int | None):
    """The second filter's slice of each chunk, and its hashes of more than ``most`` places; rows come sorted by chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, once, twice, counts, n_counts = None, None, None, [], 0

        def out():
            packed, hot = np.packbits(twice, bitorder="little").tobytes(), NONE
            if counts:
                rows = _summed(counts)
                hot = _names(rows[rows[:, 1] > most, 0], chunks)
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([packed], pa.binary()),
                                               pa.array([hot.tobytes()], pa.binary())], names=["chunk", "twice", "hot"])

        for batch in batches:
            for chunk, blob, counted in zip(*(batch.column(c).to_pylist() for c in range(3))):
                if chunk != at:
                    if at is not None:
                        yield out()
                    at, once, twice = chunk, np.zeros(CHUNK_BITS, bool), np.zeros(CHUNK_BITS, bool)
                    counts, n_counts = [], 0
                if counted is not None:
                    counts.append(np.frombuffer(counted, np.uint64).reshape(-1, 2))
                    n_counts += len(counts[-1])
                    if n_counts >= HELD:
                        counts, n_counts = [_summed(counts)], 0
                    continue
                wide = np.zeros((len(blob) // SENT, 8), np.uint8)
                wide[:, :SENT] = np.frombuffer(blob, np.uint8).reshape(-1, SENT)
                h, n = np.unique(wide.view("<u8").ravel() & np.uint64((1 << 36) - 1), return_counts=True)
                a, b = _bits(h)
                again = once[a] & once[b] | (n > 1)
                twice[a[again]] = twice[b[again]] = True
                once[a] = once[b] = True
        if at is not None:
            yield out()

    return run


def seen_twice(rows: DataFrame, hashes: Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, np.ndarray]]], bits: int,
               most: int | None = None, freed: bool = False):
    """The second filter over ``rows``, broadcast (``bits`` / 8 bytes), with the hashes of more than ``most`` places.

    ``hashes`` yields, by batch, two arrays of hashes (uint64): each document's
    distinct ones, and those of its further places.
    """
    chunks = bits // CHUNK_BITS
    dealt = rows.mapInArrow(_dealt(hashes, chunks, most is not None), "chunk int, hashes binary, counts binary")
    filled = stored(dealt.repartition("chunk").sortWithinPartitions("chunk")
                    .mapInArrow(_filled(chunks, most), "chunk int, twice binary, hot binary"), "seen_twice", freed=freed)
    twice, hot = np.zeros((chunks, CHUNK_BITS // 8), np.uint8), [NONE]
    for row in filled.toLocalIterator():  # bits / 8 bytes at most, and one of ``most`` hashes
        twice[row.chunk] = np.frombuffer(row.twice, np.uint8)
        hot.append(np.frombuffer(row.hot, np.uint64))
    return rows.sparkSession.sparkContext.broadcast(Seen(twice, np.unique(np.concatenate(hot))))


def suspected(seen: Seen, h: np.ndarray) -> np.ndarray:
    """Which hashes the filter holds."""
    chunk, hit = _chunk(h, len(seen.twice)), np.ones(len(h), bool)
    for bit in _bits(h):
        hit &= seen.twice[chunk, bit >> 3] >> (bit & 7).astype(np.uint8) & 1 == 1
    return hit


def crowded(seen: Seen, h: np.ndarray) -> np.ndarray:
    """Which hashes occur too often."""
    if not len(seen.hot):
        return np.zeros(len(h), bool)
    names = _names(h, len(seen.twice))
    return seen.hot[np.minimum(np.searchsorted(seen.hot, names), len(seen.hot) - 1)] == names
