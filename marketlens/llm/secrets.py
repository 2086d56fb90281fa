"""Secret scan: fixed patterns, and strings that a battery of randomness tests can't tell from keys.

Besides the base patterns, every run of at least ``LEAST`` key characters with a digit and a
letter is a candidate.  Its encoding is inferred (hex, base32, else base64) and its
symbols take three tests of randomness:

* chi-squared: the symbols are uniform over the encoding's alphabet;
* runs (Wald-Wolfowitz): neighbours change between the alphabet's halves as often as by chance;
* serial correlation of neighbouring symbols.

Each is a normal deviate with the moments of its length; the largest of the three in
absolute value is the candidate's score, small for random strings.  A candidate that a test
rejects (``REJECT``) is no secret.  For the others the question is whether ordinary text
scores as low: all texts, less their candidates, are cut into windows of each encoding's
symbols and of each length class, and scored alike.  A candidate's p-value is the share of
ordinary windows of its encoding and length class that score no higher; short strings, on
which the battery has little power, thus get large p-values.  Benjamini-Hochberg over
all candidates of the corpus keeps the share of false discoveries below ``FALSE_SHARE``.

Scores travel as counts by (encoding, length class, binned score), a table of ``CELLS``
cells at most; texts are read once, and a document's candidates stay on its row.

Defined results: null and empty texts have no spans; offsets are code points, ends
exclusive; added spans that overlap a base span are left out; all-digit or all-letter runs are no
candidates; a document's row is judged by itself, equal doc_ids and repeated rows
included; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.common import slices, stored, through_arrow

#: The base patterns, in the order of their kinds.  Whole matches are spans.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.ASCII | re.IGNORECASE)
ACCESS, HEX = re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]{32,}")
ASSIGN_LEAST, ACCESS_LEAST = 8, 16
BASE_KINDS = ("assign", "access", "hex")

#: Shortest candidate, largest deviate of a random string, share of false discoveries.
LEAST, REJECT, FALSE_SHARE = 16, 3.5, 0.01
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{%d,}={0,2}" % LEAST)
#: Lengths of ordinary windows; a candidate belongs to the longest that it reaches.
CLASSES = (16, 24, 32, 48, 64, 128)
#: Scores are counted by steps of 1 / ``FINE`` up to ``BINS``, where all higher ones go.
FINE, BINS = 8, 64
#: Symbols of ordinary windows that are scored at once.
CHUNK = 1 << 18


def _alphabet(symbols: str, also: str = "") -> np.ndarray:
    """Code of each byte, -1 for others; ``also`` has other writings of the first or last symbols."""
    codes = np.full(256, -1, np.int16)
    for i, c in enumerate(symbols):
        codes[ord(c)] = i
    for i, c in enumerate(also):
        codes[ord(c)] = i if also != "-_" else len(symbols) - 2 + i
    return codes


_DIGITS, _UPPER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Encodings: name, pattern of a whole candidate, alphabet size, code of each byte (both cases, both variants).
_B32 = _UPPER + "234567"
ENCODINGS = (
    ("hex", re.compile("[0-9a-f]+|[0-9A-F]+"), 16, _alphabet(_DIGITS + "abcdef", _DIGITS + "ABCDEF")),
    ("base32", re.compile("[A-Z2-7]+"), 32, _alphabet(_B32, _B32.lower())),
    ("base64", re.compile(".+"), 64, _alphabet(_UPPER + _UPPER.lower() + _DIGITS + "+/", "-_")),
)
CELLS = len(ENCODINGS) * len(CLASSES) * (BINS + 1)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns' matches, by start and kind."""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_LEAST]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def encoding_of(body: str) -> int | None:
    """The first encoding whose alphabet holds all of ``body``; None without both a digit and a letter."""
    if not (any("0" <= c <= "9" for c in body) and any(c.isalpha() for c in body)):
        return None
    return next(i for i, e in enumerate(ENCODINGS) if e[1].fullmatch(body))


def class_of(n):
    return np.searchsorted(CLASSES, n, side="right") - 1


def battery(codes: np.ndarray, lens: np.ndarray, size: int) -> np.ndarray:
    """Scores of strings: their codes one after another, their lengths, the size of the alphabet."""
    n, start = lens.astype(float), np.cumsum(lens) - lens
    total = lambda x: np.add.reduceat(x, start)
    of = np.repeat(np.arange(len(lens), dtype=np.int32), lens)
    # chi-squared, by the cube-root approximation with the exact mean and variance of multinomial counts
    counts = np.bincount(of * size + codes, minlength=len(lens) * size).reshape(len(lens), size)
    chi = size / n * np.einsum("ij,ij->i", counts, counts) - n
    k = (size - 1) * n / (n - 1)
    uniform = (np.cbrt(chi / (size - 1)) - (1 - 2 / (9 * k))) / np.sqrt(2 / (9 * k))
    # runs of the alphabet's halves; a string's first symbol has no neighbour before it
    upper = codes >= size // 2
    change = np.zeros(len(codes), np.int32)
    change[1:] = upper[1:] != upper[:-1]
    change[start] = 0
    changes = (total(change) - (n - 1) / 2) / np.sqrt((n - 1) / 4)
    # serial correlation of neighbours, about the mean of the string
    x = codes - np.repeat(total(codes.astype(float)) / n, lens)
    joint = np.zeros(len(codes))
    joint[1:] = x[1:] * x[:-1]
    joint[start] = 0
    spread = total(x * x)
    with np.errstate(divide="ignore", invalid="ignore"):
        serial = (total(joint) / spread + 1 / n) * np.sqrt(n)
    serial = np.where(spread > 0, serial, np.inf)
    return np.abs(np.stack([uniform, changes, serial])).max(axis=0)


def cell(encoding, klass, score):
    return (encoding * len(CLASSES) + klass) * (BINS + 1) + np.minimum(np.floor(score * FINE), BINS).astype(np.int64)


def ordinary_counts(texts: list[str]) -> np.ndarray:
    """Windows of ordinary text by cell: each text less its candidates, cut anew for every encoding and length."""
    counts = np.zeros(CELLS, np.int64)
    raw = [np.frombuffer(CANDIDATE.sub(" ", t).encode("utf-8", "surrogatepass"), np.uint8) for t in texts]
    for e, (_, _, size, alphabet) in enumerate(ENCODINGS):
        codes = [c[c >= 0] for c in (alphabet[r] for r in raw)]
        for k, length in enumerate(CLASSES):
            whole = [c[:len(c) // length * length] for c in codes if len(c) >= length]
            if not whole:
                continue
            flat = np.concatenate(whole)
            step = CHUNK // length * length
            for a in range(0, len(flat), step):
                part = flat[a:a + step]
                score = battery(part, np.full(len(part) // length, length), size)
                counts += np.bincount(cell(e, k, score), minlength=CELLS)
    return counts


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, bool]]:
    """(start, end, cell, free) of the text's candidates; free: no base span overlaps it."""
    found = []
    for m in CANDIDATE.finditer(text):
        body = m.group().rstrip("=")
        if (e := encoding_of(body)) is not None:
            codes = ENCODINGS[e][3][np.frombuffer(body.encode(), np.uint8)]
            score = battery(codes, np.array([len(codes)]), ENCODINGS[e][2])
            at = int(cell(e, class_of(len(codes)), score)[0])
            free = not any(a < m.end() and m.start() < b for a, _, b in base)
            found.append((m.start(), m.end(), at, free))
    return found


_SCANNED = ("doc_id long, base array<struct<start:long,kind:int,end:long>>, "
            "found array<struct<start:long,end:long,cell:int,free:boolean>>, ordinary array<long>")
_BASE = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
_FOUND = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("cell", pa.int32()), ("free", pa.bool_())]))


def _scan(batches):
    counts = np.zeros(CELLS, np.int64)
    for batch in slices(batches):
        texts = [t.as_py() or "" for t in batch.column(1)]
        base = [base_spans(t) for t in texts]
        found = [candidates(t, b) for t, b in zip(texts, base)]
        counts += ordinary_counts(texts)
        yield _scanned(batch.column(0), base, found, pa.nulls(len(texts), pa.list_(pa.int64())))
    yield _scanned(pa.nulls(1, pa.int64()), [[]], [[]], pa.array([counts], pa.list_(pa.int64())))


def _scanned(doc_ids, base, found, ordinary) -> pa.RecordBatch:
    spans = pa.array([[dict(zip(("start", "kind", "end"), s)) for s in b] for b in base], _BASE)
    cands = pa.array([[dict(zip(("start", "end", "cell", "free"), s)) for s in f] for f in found], _FOUND)
    return pa.RecordBatch.from_arrays([doc_ids, spans, cands, ordinary], names=["doc_id", "base", "found", "ordinary"])


def discoveries(scanned: DataFrame) -> DataFrame:
    """Cells whose candidates are secrets (``cell``): Benjamini-Hochberg over all candidates of the corpus."""
    ordinary = (scanned.filter("ordinary IS NOT NULL").select(F.posexplode("ordinary").alias("cell", "k")).filter("k > 0")
                .groupBy("cell").agg(F.sum("k").alias("k"), F.lit(0).cast("long").alias("m")))
    found = (scanned.select(F.explode("found").alias("c")).groupBy(F.col("c.cell").alias("cell"))
             .agg(F.lit(0).cast("long").alias("k"), F.count(F.lit(1)).alias("m")))
    cells = ordinary.unionByName(found).groupBy("cell").agg(F.sum("k").alias("k"), F.sum("m").alias("m"))
    cells = cells.withColumn("stratum", F.expr(f"cell div {BINS + 1}"))
    stratum = Window.partitionBy("stratum")                                     # windows over CELLS rows at most
    low = F.sum("k").over(stratum.orderBy("cell"))
    cells = cells.withColumn("p", (low + 1) / (F.sum("k").over(stratum) + 1))
    every = Window.partitionBy()
    upto = F.sum("m").over(Window.orderBy("p").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    cells = cells.withColumns({"upto": upto, "all": F.sum("m").over(every)})
    passing = F.when(F.col("p") * F.col("all") <= F.col("upto") * FALSE_SHARE, F.col("p"))
    fits = F.col("cell") % (BINS + 1) < int(REJECT * FINE)
    return cells.withColumn("most", F.max(passing).over(every)).filter((F.col("m") > 0) & fits & (F.col("p") <= F.col("most"))).select("cell")


def report(docs: DataFrame) -> DataFrame:
    """One row per document: base counts and their digest, and all spans, the method's included."""
    scanned = stored(through_arrow(docs.select("doc_id", "text"), _scan, _SCANNED), "secrets_scan", "zstd")
    kept = discoveries(scanned).agg(F.collect_set("cell").alias("cells")).scalar()        # CELLS values at most
    rows = scanned.filter("ordinary IS NULL").withColumn("cells", kept)
    names = F.array(*[F.lit(k) for k in BASE_KINDS])
    kinds = F.array(*[F.lit(f"random_{e[0]}") for e in ENCODINGS])
    per = len(CLASSES) * (BINS + 1)
    text = lambda kind, a, b: F.concat_ws(":", kind, a.cast("string"), b.cast("string"))
    base = F.transform("base", lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), text(F.get(names, s["kind"]), s["start"], s["end"]).alias("span")))
    rows = rows.withColumn("spans_base", base).withColumn("secret", F.filter(
        "found", lambda c: c["free"] & F.array_contains(F.col("cells"), c["cell"])))
    added = F.transform("secret", lambda c: F.struct(
        c["start"].alias("start"), (F.floor(c["cell"] / per) + len(BASE_KINDS)).cast("int").alias("kind"),
        text(F.get(kinds, F.floor(c["cell"] / per).cast("int")), c["start"], c["end"]).alias("span")))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: s["span"]), ",")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return rows.select(
        "doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(BASE_KINDS)],
        F.size("secret").cast("long").alias("n_random"), F.sha2(joined("spans_base"), 256).alias("base_sha256"),
        joined(F.sort_array(F.concat("spans_base", added))).alias("spans"))
