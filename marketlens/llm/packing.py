"""Packing token sequences into fixed windows by minimum bin slack.

Every document becomes its token ids plus an end id.  Whole windows are cut
off its front; what remains, ``n % capacity`` ids, is one residual.  Only the
histogram of residual lengths (at most ``capacity - 1`` numbers, whatever the
corpus size) reaches the planner.  The planner takes the longest remaining
length, finds by a bitset subset-sum dynamic programme the multiset of
remaining lengths that fills the window closest to capacity, reads its counts
back from the stored bitsets and repeats that window as often as the counts
allow.  A length that no multiset completes is cut into its binary digits:
these pieces join the histogram, and a power of two that stays alone is a
sequence without padding.

Documents find their place by (length, rank among residuals of that length).
Ranks come from counters inside each task plus one prefix sum per (length,
task), so a length shared by a third of all documents is never gathered.

Defined results: null text counts as empty, an empty document is its end id
alone; repeated rows are packed once each; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm import letters
from marketlens.llm.common import byte_of_char, stored, text_or_empty

CAPACITY = 4096
END_ID = 2
#: Words whose ids a Python worker remembers; the memory is emptied when full.
CACHED_WORDS = 400_000

UNITS = ("doc_id long, doc_tokens long, cls int, part int, lrank long, start long, "
         "crc long, cut_crcs array<long>")
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


class WordIds:
    """Ids (little-endian uint32 bytes) of texts, word by word.

    The tokenizer drops white space and never joins across it, so a text's ids
    are those of its white-space separated words, and known words are looked up.
    New words are normalised by the tokenizer, split by its pattern, and merged
    by tiktoken under the same merge order, with byte 1 as the end-of-word mark.
    Both merge alike when every entry encodes to itself, which is checked here.
    Words with a letter or numeral that ``regex`` classes otherwise go to the tokenizer.
    """

    _open: dict[str, WordIds] = {}
    #: The split that the tokenizer file states, for any text, and as Python's
    #: faster patterns have it for Latin letters, where lower() is the whole normalisation.
    _split = regex.compile(r"('s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+)")
    _latin = re.compile("[ -~\xa1-\u012f\u0131-\u017f]*")
    _split_latin = re.compile("('s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ſ]+|[0-9²³¹¼-¾]|[^ a-z0-9ªµºß-öø-ſ²³¹¼-¾]+)")
    #: Byte 1 is the mark; Python, but not the tokenizer, splits at 1C-1F.
    _odd = re.compile("[\x01\x1c-\x1f]")

    def __init__(self, path: str, remembered: int = CACHED_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json

        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        raw = byte_of_char()

        def as_bytes(entry: str) -> bytes:
            stem, mark = (entry[:-len(end)], b"\x01") if entry.endswith(end) else (entry, b"")
            return bytes(raw[c] for c in stem) + mark

        ranks = {bytes([b]): b for b in range(256)} | {bytes([b, 1]): 256 + b for b in range(256)}
        for pair in model["merges"]:
            ranks[as_bytes("".join(pair if isinstance(pair, list) else pair.split(" ")))] = len(ranks)
        self.id_of_rank = np.zeros(len(ranks), "<u4")
        for entry, i in vocab.items():
            if entry and all(c in raw for c in entry.removesuffix(end)) and as_bytes(entry) in ranks:
                self.id_of_rank[ranks[as_bytes(entry)]] = i
                tokens = self.tokenizer.model.tokenize(entry.removesuffix(end)) if entry.endswith(end) else ()
                if len(tokens) > 1:
                    raise ValueError(f"entry {entry!r} doesn't encode to itself")
        self.merge = tiktoken.Encoding("words", pat_str="[^ \x01]*\x01| ", mergeable_ranks=ranks,
                                       special_tokens={}).encode_ordinary
        self.unlike = letters.any_of(letters.stand_ins(letters.by_tokenizers))
        self.known: dict[str, bytes] = {}
        self.remembered = remembered

    @classmethod
    def of(cls, path: str, remembered: int = CACHED_WORDS) -> WordIds:
        if path not in cls._open:
            cls._open[path] = cls(path)
        cls._open[path].remembered = remembered
        return cls._open[path]

    def _plain(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _new(self, words: list[str]) -> list[bytes]:
        joined = " ".join(words)
        if not joined.isascii() and self.unlike.search(joined):
            return [self._plain(w) if self.unlike.search(w) else self._new([w])[0] for w in words]
        if self._latin.fullmatch(joined):
            marked = self._split_latin.sub("\\1\x01", joined.lower())
        else:
            marked = self._split.sub("\\1\x01", self.tokenizer.normalizer.normalize_str(joined))
        ranks = np.array(self.merge(marked), np.int64)
        ends = np.flatnonzero(ranks == 32)
        if len(ends) != len(words) - 1:
            return [self._plain(w) for w in words]
        ids, cuts = self.id_of_rank[ranks].tobytes(), [0, *(4 * ends).tolist(), 4 * len(ranks) + 4]
        return [ids[a + 4 * (a > 0):b] for a, b in zip(cuts, cuts[1:])]

    def encode(self, text: str) -> bytes:
        if self._odd.search(text):
            return self._plain(text)
        words, known = text.split(), self.known
        got = list(map(known.get, words))
        if None in got:
            missing = [i for i, ids in enumerate(got) if ids is None]
            if len(known) + len(missing) > self.remembered:
                known.clear()
            new = [words[i] for i in missing]
            for i, word, ids in zip(missing, new, self._new(new)):
                got[i] = known[word] = ids
        return b"".join(got)


def binary_digits(n: int) -> list[int]:
    """The powers of two that sum to ``n``, largest first."""
    return [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


def _units(path: str, capacity: int, end_id: int):
    step = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = WordIds.of(path), np.array([end_id], "<u4").tobytes()
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        schema = pa.schema([("doc_id", pa.int64()), ("doc_tokens", pa.int64()), ("cls", pa.int32()),
                            ("part", pa.int32()), ("lrank", pa.int64()), ("start", pa.int64()),
                            ("crc", pa.int64()), ("cut_crcs", pa.list_(pa.int64()))])
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = memoryview(words.encode(text.as_py()) + end)
                n = len(ids) // 4
                for start in range(0, n, capacity):
                    piece = ids[4 * start:4 * start + step]
                    cls, cuts = len(piece) // 4, None
                    if cls < capacity and cls & (cls - 1):
                        at, cuts = 0, []
                        for d in binary_digits(cls):
                            cuts.append(zlib.crc32(piece[4 * at:4 * (at + d)]))
                            at += d
                    rows.append((doc, n, cls, part, int(seen[cls]), start, zlib.crc32(piece), cuts))
                    seen[cls] += 1
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


def fullest(counts: dict[int, int], first: int, capacity: int) -> tuple[int, dict[int, int]]:
    """The multiset with one ``first`` that fills ``capacity`` best: (fill, {length: uses}).

    ``counts`` bounds the uses.  Bit t of a bitset says that t is a sum of the
    lengths seen so far; uses are split binarily, so a length costs log(uses) steps.
    """
    room, reach, steps = capacity - first, 1, []
    mask = (1 << room + 1) - 1
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, k = min(counts[length] - (length == first), room // length), 1
        while left > 0:
            k = min(k, left)
            steps.append((length, k, reach))
            reach |= reach << length * k & mask
            left -= k
            k *= 2
        if reach >> room & 1:
            break
    best = t = reach.bit_length() - 1
    uses = {first: 1}
    for length, k, before in reversed(steps):
        if not before >> t & 1:
            t -= length * k
            uses[length] = uses.get(length, 0) + k
    return first + best, uses


def plan(counts: dict[int, int], capacity: int, first_sequence: int) -> tuple[np.ndarray, np.ndarray]:
    """Where residuals go: rows (cls, from, to, cut, sequence, windows, offset) and cut bases.

    A row places ranks [from, to) of a length: ``to - from`` is a multiple of
    ``windows``, and rank from + s * windows + w is item s of that length in
    window w.  Rows with ``cut`` >= 0 cut these residuals instead; the k-th row of
    the cut bases has, by binary digit, the first rank among the pieces of that size.
    """
    left = {x: n for x, n in counts.items() if n}
    used = dict.fromkeys(range(capacity), 0)
    made = dict(counts)
    rows, bases, sequence = [], [], first_sequence
    while left:
        longest = max(left)
        fill, uses = fullest(left, longest, capacity)
        alone = longest & (longest - 1) == 0
        if fill < capacity and not alone:
            n, base = left.pop(longest), [-1] * capacity.bit_length()
            for d in binary_digits(longest):
                base[d.bit_length() - 1] = made.get(d, 0)
                made[d] = made.get(d, 0) + n
                left[d] = left.get(d, 0) + n
            rows.append((longest, used[longest], used[longest] + n, len(bases), 0, 1, 0))
            used[longest] += n
            bases.append(base)
            continue
        if fill < capacity:
            uses = {longest: 1}
        windows, offset = min(left[x] // k for x, k in uses.items()), 0
        for x in sorted(uses, reverse=True):
            n = windows * uses[x]
            rows.append((x, used[x], used[x] + n, -1, sequence, windows, offset))
            used[x] += n
            offset += x * uses[x]
            left[x] -= n
            if not left[x]:
                del left[x]
        sequence += windows
    return (np.array(sorted(rows), np.int64).reshape(-1, 7),
            np.array(bases, np.int64).reshape(-1, capacity.bit_length()))


def _place(placed, capacity: int):
    def find(rows, cls, rank):
        keys = rows[:, 0] * (1 << 48) + rows[:, 1]
        hit = rows[np.searchsorted(keys, cls * (1 << 48) + rank, side="right") - 1]
        t = rank - hit[:, 1]
        return hit[:, 3], t, hit[:, 4] + t % hit[:, 5], hit[:, 6] + t // hit[:, 5] * cls

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, bases = placed.value
        names = [x.split()[0] for x in PIECES.split(", ")]
        for batch in batches:
            doc, total = batch.column("doc_id"), batch.column("doc_tokens")
            cls, rank, start, crc = (batch.column(c).to_numpy().astype(np.int64)
                                     for c in ("cls", "rank", "start", "crc"))
            full = cls == capacity
            seq, off, cut = rank.copy(), np.zeros_like(rank), np.full(len(rank), -1)
            if (~full).any():
                cut[~full], nth, seq[~full], off[~full] = find(rows, cls[~full], rank[~full])
                nth_of = np.zeros_like(rank)
                nth_of[~full] = nth
            whole = np.flatnonzero(cut < 0)
            at, out = [whole], [start[whole], cls[whole], crc[whole], seq[whole], off[whole]]
            more = []
            for i in np.flatnonzero(cut >= 0):
                begin = int(start[i])
                for d, c in zip(binary_digits(int(cls[i])), batch.column("cut_crcs")[i].as_py()):
                    more.append((i, begin, d, c, bases[cut[i], d.bit_length() - 1] + nth_of[i]))
                    begin += d
            if more:
                m = np.array(more, np.int64)
                _, _, s, o = find(rows, m[:, 2], m[:, 4])
                at.append(m[:, 0])
                out = [np.concatenate(x) for x in zip(out, (m[:, 1], m[:, 2], m[:, 3], s, o))]
            at = pa.array(np.concatenate(at))
            cols = [doc.take(at), *map(pa.array, out[:3]), total.take(at), *map(pa.array, out[3:])]
            yield pa.RecordBatch.from_arrays([c.cast(pa.int64()) for c in cols], names=names)

    return run


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece of a document: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Sequences of whole windows come first; the others follow by plan.  ``capacity``
    must be a power of two (binary digits then complete every window).
    """
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    units = stored(texts.mapInArrow(_units(tokenizer_path, capacity, end_id), UNITS), "pack_units")
    per_task = units.groupBy("cls", "part").agg(F.count(F.lit(1)).alias("n"))
    per_task = stored(per_task, "pack_counts")
    counts = {r.cls: r.n for r in per_task.groupBy("cls").agg(F.sum("n").alias("n")).collect()}
    windows = counts.pop(capacity, 0)
    placed = spark.sparkContext.broadcast(plan(counts, capacity, windows))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("cls").orderBy("part")
                                        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = (units.join(per_task.select("cls", "part", before.alias("before")), ["cls", "part"])
              .select("doc_id", "doc_tokens", "cls", (F.col("before") + F.col("lrank")).alias("rank"),
                      "start", "crc", "cut_crcs"))
    return ranked.mapInArrow(_place(placed, capacity), PIECES)
