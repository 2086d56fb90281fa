"""Byte-level BPE by a sentencepiece model made directly from a rank file.

Every entry of the vocabulary becomes a piece: its bytes, each as its printable
stand-in, scored by the negative rank, so that sentencepiece's best-scoring pair
is the pair of the least rank.  The normaliser is the identity.  Texts are split
by the vocabulary's pattern and each match is encoded for itself; decoding maps
ids back to bytes.  Tasks remember the ids of words they have met (bounded).

Defined results: null text counts as empty (no ids); repeated rows are encoded
once each; an empty table gives no rows; the input's columns stay as they are,
and the new ones have names that the caller chooses.
"""

from __future__ import annotations

import base64
import re
import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructType

from marketlens.llm import letters
from marketlens.llm.common import byte_of_char, free_name, text_or_empty, through_arrow

#: Words whose ids a Python worker remembers; the memory is emptied when full.
CACHED_WORDS = 250_000
#: Rows, and bytes of text, after which a task passes results on.
ROWS_OUT, BYTES_OUT = 1000, 8 << 20
#: White space as Unicode has it, which is what the pattern's class means.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def read_ranks(path: str) -> list[bytes]:
    """The vocabulary of a rank file, by rank."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    entries = sorted(ranks, key=ranks.get)
    if [ranks[e] for e in entries] != list(range(len(entries))):
        raise ValueError("ranks must run from 0 without gaps")
    return entries


def _varint(n: int) -> bytes:
    out = bytearray()
    n &= (1 << 64) - 1
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: bytes | int | float) -> bytes:
    """One protobuf field: bytes, integer or 32-bit float."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def model_bytes(entries: list[bytes]) -> bytes:
    """A serialised sentencepiece model; the piece of rank r has id r + 1 (0 is unknown)."""
    char = {b: c for c, b in byte_of_char().items()}
    normal, unknown, bpe = 1, 2, 2
    pieces = [_field(1, b"<unk>") + _field(2, 0.0) + _field(3, unknown)]
    pieces += [_field(1, "".join(map(char.get, e)).encode()) + _field(2, -float(r)) + _field(3, normal)
               for r, e in enumerate(entries)]
    trainer = (_field(3, bpe) + _field(4, len(pieces)) + _field(40, 0)
               + _field(41, -1) + _field(42, -1) + _field(43, -1))
    normalizer = _field(1, b"identity") + _field(2, b"") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(_field(1, p) for p in pieces) + _field(2, trainer) + _field(3, normalizer)


class Codec:
    """Encoder and decoder of one rank file under one pattern."""

    _open: dict[tuple[str, str], Codec] = {}
    _by_spaces = re.compile(f"[{WHITE}] | [{WHITE}]")

    def __init__(self, path: str, pattern: str):
        from sentencepiece import SentencePieceProcessor

        self.entries = read_ranks(path)
        self.model = SentencePieceProcessor(model_proto=model_bytes(self.entries))
        # the class names white space itself: libraries differ on four control characters
        self.split = regex.compile(pattern.replace(r"[^\s", f"[^{WHITE}").replace(r"\s", f"[{WHITE}]")
                                   .replace(r"\S", f"[^{WHITE}]"))
        self.alike = letters.stand_ins(letters.by_tiktoken)
        self.unlike = letters.any_of(self.alike)
        self.stand_in = [c for c, _ in sorted(byte_of_char().items(), key=lambda x: x[1])]
        self.known: dict[str, bytes] = {}
        self.tokens: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str, pattern: str) -> Codec:
        if (path, pattern) not in cls._open:
            cls._open[path, pattern] = cls(path, pattern)
        return cls._open[path, pattern]

    def _mapped(self, token: str) -> str:
        if token.isascii() and token.isprintable():
            return token.replace(" ", self.stand_in[32])
        return "".join([self.stand_in[b] for b in token.encode()])

    def _matches(self, text: str) -> list[str]:
        """The pattern's matches as tiktoken finds them, characters that it classes otherwise included."""
        if text.isascii() or not self.unlike.search(text):
            return self.split.findall(text)
        return [text[m.start():m.end()] for m in self.split.finditer(text.translate(self.alike))]

    def _new(self, words: list[str]) -> list[bytes]:
        """Piece ids (rank + 1, little-endian) of words not remembered, by their matches."""
        found, tokens = [self._matches(w) for w in words], self.tokens
        new = list({t for own in found for t in own if t not in tokens})
        if len(tokens) + len(new) > CACHED_WORDS:
            tokens.clear()
            new = list({t for own in found for t in own})
        for token, ids in zip(new, self.model.encode([self._mapped(t) for t in new], num_threads=1)):
            tokens[token] = array("i", ids).tobytes()
        return [b"".join([tokens[t] for t in own]) for own in found]

    def encode(self, text: str) -> np.ndarray:
        """Ids, as ranks.  A match begins at every single space, so words are encoded one by one."""
        if not text:
            return np.empty(0, "<i4")
        if self._by_spaces.search(text):
            words = self._matches(text)
        else:
            first, *rest = text.split(" ")
            words = [first] * (first != "") + [" " + w for w in rest]
        known = self.known
        got = list(map(known.get, words))
        if None in got:
            missing = [i for i, ids in enumerate(got) if ids is None]
            if len(known) + len(missing) > CACHED_WORDS:
                known.clear()
            new = [words[i] for i in missing]
            for i, word, ids in zip(missing, new, self._new(new)):
                got[i] = known[word] = ids
        return np.frombuffer(b"".join(got), "<i4") - np.int32(1)

    def decode(self, ids: np.ndarray) -> bytes:
        entries = self.entries
        return b"".join([entries[i] for i in ids.tolist()])


def _run(path: str, pattern: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(path, pattern)

        def out(batch, start, ids, raw):
            part = batch.slice(start, len(ids))
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            lists = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(ids) if ids else [], pa.int32()))
            return pa.RecordBatch.from_arrays([*part.columns[:-1], lists, pa.array(raw, pa.binary())],
                                              names=names)

        for batch in batches:
            start, ids, raw, size = 0, [], [], 0
            for i, text in enumerate(batch.column(batch.num_columns - 1)):
                ids.append(codec.encode(text.as_py()))
                raw.append(codec.decode(ids[-1]))
                size += len(raw[-1])
                if len(ids) >= ROWS_OUT or size >= BYTES_OUT:
                    yield out(batch, start, ids, raw)
                    start, ids, raw, size = i + 1, [], [], 0
            if ids:
                yield out(batch, start, ids, raw)

    return run


def encode_decode(rows: DataFrame, text: str, path: str, pattern: str,
                  ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``rows`` with two more columns: the text's ids (array of int) and the bytes they decode to."""
    name = free_name(rows, "coded_text")
    schema = StructType([*rows.schema.fields]).add(ids, ArrayType(IntegerType())).add(decoded, BinaryType())
    given = rows.select(*[F.col(f"`{c}`") for c in rows.columns], text_or_empty(text).alias(name))
    return through_arrow(given, _run(path, pattern, schema.names), schema)


def report(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    d = docs.select("doc_id", F.col("text").alias("given"))
    coded = encode_decode(d, "given", path, pattern).drop("given")
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
