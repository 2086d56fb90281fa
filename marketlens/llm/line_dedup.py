"""Line dedup with two Bloom filters: only lines suspected of repeating are shuffled.

Pass one hashes the distinct line keys of each document.  Hashes are dealt by
their top bits to chunks; a chunk holds its slice of two Bloom filters, "seen
once" and "seen twice", and a hash whose bits are all set in the first goes into
the second.  The second filter holds every key of two or more documents, and
some more.  Pass two tests every line against it; only suspects travel, with
their whole key, for the exact answer: the key's first document, if it has two.
Pass three drops the lines.

The filters' size follows the corpus up to ``MAX_BITS`` (a 128 MB broadcast).  A
larger corpus has more false suspects, so more lines travel; the result stays
exact.  A line that a third of all documents hold is one hash per task in pass
one; in the exact step its holders are dealt to parts by document, each part
finds its own first document, and the join back is by key and part.

Defined results: null or empty text is one empty line; null doc_id is one
document after all others; rows with one doc_id are one document; an empty
table gives no rows; other columns, whatever their names, are passed through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm import repeats
from marketlens.llm.common import free_name, slices, stored, text_or_empty, through_arrow

SPACE = " \t\n\x0b\x0c\r"
MIN_KEY_CHARS = 10
#: Filter bits per line, at an assumed 40 bytes a line.
BITS_PER_LINE, LINE_BYTES = 12, 40
MAX_BITS = 1 << 30
#: Parts that the holders of one key are dealt to, by document: the least number, and suspects for each.
LEAST_PARTS, PART_ROWS = 64, 200_000
LAST = (1 << 63) - 1


def keys_of(text: str) -> list[bytes | None]:
    """The key of each line; None for lines too short to count."""
    return [k.encode().lower() if len(k := line.strip(SPACE)) >= MIN_KEY_CHARS else None
            for line in text.split("\n")]


def _hashes(keys) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), np.uint64, len(keys))


def _document_hashes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    for text in batch.column(0):
        keys = {k for k in keys_of(text.as_py()) if k is not None}
        if keys:
            yield _hashes(keys), repeats.NONE


def _suspects(found):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            docs, rks, keys = [], [], []
            for doc, rk, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                own = list({k for k in keys_of(text.as_py()) if k is not None})
                if own:
                    hit = np.flatnonzero(repeats.suspected(found.value, _hashes(own)))
                    docs += [doc] * len(hit)
                    rks += [rk] * len(hit)
                    keys += [own[i] for i in hit]
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(rks, pa.int64()),
                                              pa.array(keys, pa.binary())], names=["doc", "rk", "key"])

    return run


def repeated_keys(docs: DataFrame, doc: str, rk: str, text: str) -> DataFrame:
    """(doc, rk, keys): by document and text (its hash), the distinct keys whose lines it loses.

    A list is bounded by one text, however many rows a document has.
    """
    texts = docs.select(F.col(doc).alias("doc"), F.col(rk).alias("rk"), F.col(text).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = repeats.filter_bits(size // LINE_BYTES, BITS_PER_LINE, MAX_BITS)
    found = repeats.seen_twice(texts.select("text"), _document_hashes, bits)
    suspects = stored(texts.mapInArrow(_suspects(found), "doc long, rk long, key binary"), "line_suspects")
    parts = max(LEAST_PARTS, -(-suspects.count() // PART_ROWS))
    dealt = suspects.withColumn("part", F.pmod(F.xxhash64("doc", "rk"), F.lit(parts)).cast("int"))
    # a key has at most one row of each part here, however many lines hold it
    key = Window.partitionBy("key")
    first = (dealt.groupBy("key", "part").agg(F.min("doc").alias("least"), F.max("doc").alias("most"))
             .select("key", "part", F.min("least").over(key).alias("first"), F.max("most").over(key).alias("last"))
             .filter("first < last").select("key", "part", "first"))
    return (dealt.join(first, ["key", "part"]).filter("doc > first").select("doc", "rk", "key")
            .groupBy("doc", "rk").agg(F.collect_set("key").alias("keys")))


def _dropped(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from (dropped(batch) for batch in slices(batches))

    def dropped(batch: pa.RecordBatch) -> pa.RecordBatch:
        cols = [batch.column(c) for c in range(batch.num_columns - 2)]
        n_lines, n_dropped, kept = [], [], []
        for text, lost in zip(batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)):
            text, lost = text.as_py(), set(lost.as_py() or ())
            lines = text.split("\n")
            if lost:
                stay = [x for x, k in zip(lines, keys_of(text)) if k is None or k not in lost]
            else:
                stay = lines
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(stay))
            kept.append("\n".join(stay) if len(stay) < len(lines) else text)
        cols += [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()),
                 pa.array(kept, batch.schema.field(batch.num_columns - 2).type)]
        return pa.RecordBatch.from_arrays(cols, names=names)

    return run


def dedup_lines(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with three more columns: lines before, lines dropped, and the text that stays.

    The second result maps "n_lines", "n_dropped" and "kept" to their column names.
    """
    from pyspark.sql.types import LongType, StringType, StructType

    doc, rk, text = (free_name(docs, f"line_{c}") for c in ("doc", "rk", "text"))
    keyed = docs.withColumns({doc: F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)),
                              rk: F.xxhash64(text_or_empty()), text: text_or_empty()})
    lost = repeated_keys(keyed, doc, rk, text).withColumnsRenamed({"doc": doc, "rk": rk})
    lost_name = free_name(keyed, "line_keys")
    joined = (keyed.join(lost.withColumnRenamed("keys", lost_name), [doc, rk], "left")
              .select(*[F.col(f"`{c}`") for c in docs.columns], text, lost_name))
    names = {c: free_name(docs, f"line_{c}") for c in ("n_lines", "n_dropped", "kept")}
    schema = StructType([*docs.schema.fields]).add(names["n_lines"], LongType()) \
        .add(names["n_dropped"], LongType()).add(names["kept"], StringType())

    return through_arrow(joined, _dropped(schema.names), schema), names


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped, kept_sha256."""
    d, names = dedup_lines(docs.select("doc_id", "text"))
    return d.select("doc_id", F.col(names["n_lines"]).alias("n_lines"), F.col(names["n_dropped"]).alias("n_dropped"),
                    F.sha2(F.col(names["kept"]), 256).alias("kept_sha256"))


def keep(docs: DataFrame) -> DataFrame:
    """The documents without their repeated lines; other columns unchanged (n_chars follows the text)."""
    d, names = dedup_lines(docs)
    out = [F.col(names["kept"]).alias(c) if c == "text"
           else F.char_length(F.col(names["kept"])).cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
           else F.col(f"`{c}`") for c in docs.columns]
    return d.select(*out)


def report_sql() -> str:
    """The same result, in DuckDB SQL."""
    blank = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(doc_id, {LAST}) AS doc,
       string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT rid, doc_id, doc, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM docs),
keyed AS (SELECT *, translate(trim(line, {blank}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
          FROM lines),
firsts AS (SELECT k, min(doc) AS first FROM keyed WHERE length(k) >= {MIN_KEY_CHARS}
           GROUP BY k HAVING count(DISTINCT doc) > 1),
flagged AS (SELECT keyed.*, coalesce(doc > first, false) AS lost FROM keyed LEFT JOIN firsts USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM flagged GROUP BY rid, doc_id"""
