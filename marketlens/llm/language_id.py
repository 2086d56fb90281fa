"""Language identification by a small byte convolutional network.

Filters of 2, 3 and 4 bytes slide over a text's bytes; each keeps its largest
response per fixed-length window, and a softmax layer reads these maxima.  The
network is trained in numpy on windows of a bounded sample of labelled documents
(``DOCS_PER_LANG`` a language, those with the least hash of their id) and sent to
the tasks, which score every window of every whole text in blocks.  A text's
scores are the softmax of its windows' mean outputs.

Defined results: null text and text without a letter (category L: numerals are none) is ``und`` with score 0, as
is all text when nothing could be learned; null lang or doc_id is never learned
from; null doc_id counts as not held out; repeated rows are scored alike; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The training sample: documents of each language, and windows of each document.
DOCS_PER_LANG, WINDOWS_PER_DOC = 300, 6
WINDOW = 256
WIDTHS, FILTERS = (2, 3, 4), 8
EPOCHS, BATCH, RATE, SEED = 12, 64, 0.02, 7
#: Windows scored at once.
BLOCK = 128
REACH = max(WIDTHS) - 1
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")


def windows_of(text: str) -> np.ndarray:
    """The text's bytes as rows of WINDOW + REACH: each window and the bytes that its last filters reach."""
    raw = np.frombuffer(text.encode(), np.uint8)
    n = max(1, -(-len(raw) // WINDOW))
    padded = np.zeros(n * WINDOW + REACH, np.uint8)
    padded[:len(raw)] = raw
    return np.lib.stride_tricks.sliding_window_view(padded, WINDOW + REACH)[::WINDOW]


class ByteNet:
    """Weights: one (bytes of the filter, 256, FILTERS) table per width, biases, and the softmax layer."""

    def __init__(self, langs: list[str]):
        rng = np.random.default_rng(SEED)
        self.langs = langs
        self.taps = [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        n = FILTERS * len(WIDTHS)
        self.out = rng.normal(0, 0.1, (n, len(langs))).astype(np.float32)
        self.bias = np.zeros(len(langs), np.float32)

    def _responses(self, x: np.ndarray) -> list[np.ndarray]:
        return [sum(t[x[:, i:i + WINDOW]] for i, t in enumerate(taps)) for taps in self.taps]

    def train(self, x: np.ndarray, y: np.ndarray) -> None:
        """Adam on the cross entropy; a maximum passes its gradient to the bytes that made it."""
        rng = np.random.default_rng(SEED)
        params = [*self.taps, self.out, self.bias]
        mean, square, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(x))
            for a in range(0, len(x), BATCH):
                xb, yb = x[order[a:a + BATCH]], y[order[a:a + BATCH]]
                responses = self._responses(xb)
                at = [r.argmax(axis=1) for r in responses]
                top = np.concatenate([r.max(axis=1) for r in responses], axis=1)
                p = _softmax(np.tanh(top) @ self.out + self.bias)
                p[np.arange(len(yb)), yb] -= 1
                p /= len(yb)
                d_top = (p @ self.out.T) * (1 - np.tanh(top) ** 2)
                grads = [np.zeros_like(t) for t in self.taps]
                rows, filters = np.arange(len(xb))[:, None], np.arange(FILTERS)[None, :]
                for k, (g, pos) in enumerate(zip(grads, at)):
                    d = d_top[:, k * FILTERS:(k + 1) * FILTERS]
                    for i in range(len(g)):
                        np.add.at(g[i], (xb[rows, pos + i], filters), d)
                grads += [np.tanh(top).T @ p, p.sum(axis=0)]
                step += 1
                for w, g, m, s in zip(params, grads, mean, square):
                    m += 0.1 * (g - m)
                    s += 0.001 * (g * g - s)
                    w -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)

    def scorer(self):
        """Windows -> outputs.  Two neighbouring bytes are looked up as one number."""
        two, three, four = self.taps
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(65536, FILTERS)
        first = np.concatenate([pair(*two), pair(three[0], three[1]), pair(four[0], four[1])], axis=1)
        last3, last4 = three[2], pair(four[2], four[3])
        f = FILTERS

        def score(x: np.ndarray) -> np.ndarray:
            pairs = x[:, :-1].astype(np.int32) * 256 + x[:, 1:]
            r = first.take(pairs[:, :WINDOW], axis=0)
            r[:, :, f:2 * f] += last3.take(x[:, 2:2 + WINDOW], axis=0)
            r[:, :, 2 * f:] += last4.take(pairs[:, 2:2 + WINDOW], axis=0)
            return np.tanh(r.max(axis=1)) @ self.out + self.bias

        return score


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_windows(docs: DataFrame) -> DataFrame:
    """(lang, window): windows, evenly spread, of the sampled documents that may be learned from."""
    given = (docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull()
                         & ~held_out(F.col("doc_id")))
             .select("lang", "text", F.xxhash64("doc_id").alias("h")))
    sizes = {r.lang: r.n for r in given.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return given.select("lang", F.lit(None).cast("binary").alias("window")).limit(0)
    # four times the wanted share first, so the exact choice sorts few rows however large a language is
    share = F.coalesce(*[F.when(F.col("lang") == k, F.lit(min(1.0, 4 * DOCS_PER_LANG / n))) for k, n in sizes.items()])
    few = given.filter(F.pmod(F.col("h"), F.lit(1 << 20)) < share * (1 << 20))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))
    chosen = few.withColumn("nth", nth).filter(F.col("nth") <= DOCS_PER_LANG).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, out = [], []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not _LETTER.search(text):
                    continue
                w = windows_of(text)
                picks = np.unique(np.linspace(0, len(w) - 1, WINDOWS_PER_DOC).astype(int))
                langs += [lang] * len(picks)
                out += [w[i].tobytes() for i in picks]
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(out, pa.binary())],
                                             names=["lang", "window"])

    return chosen.mapInArrow(run, "lang string, window binary")


def train(docs: DataFrame) -> ByteNet | None:
    rows = sorted((r.lang, bytes(r.window)) for r in training_windows(docs).collect())
    if not rows:
        return None
    net = ByteNet(sorted({lang for lang, _ in rows}))
    x = np.frombuffer(b"".join(w for _, w in rows), np.uint8).reshape(len(rows), -1)
    net.train(x, np.array([net.langs.index(lang) for lang, _ in rows]))
    return net


def _predict(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = sent.value
        score = net.scorer() if net else None
        for batch in batches:
            n = batch.num_rows
            sums, counts = np.zeros((n, len(net.langs) if net else 1)), np.zeros(n)
            held, owners = [], []

            def flush():
                if owners:
                    np.add.at(sums, np.concatenate(owners), score(np.concatenate(held)))
                    held.clear()
                    owners.clear()

            for i, text in enumerate(batch.column(1)):
                text = text.as_py()
                if net and text and _LETTER.search(text):
                    w = windows_of(text)
                    counts[i] = len(w)
                    for a in range(0, len(w), BLOCK):
                        held.append(w[a:a + BLOCK])
                        owners.append(np.full(len(held[-1]), i))
                        if sum(map(len, owners)) >= BLOCK:
                            flush()
            flush()
            p = _softmax(sums / np.maximum(counts, 1)[:, None])
            best = p.argmax(axis=1)
            known = counts > 0
            langs = [net.langs[b] if k else UNKNOWN for b, k in zip(best, known)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(langs, pa.string()),
                 pa.array(np.where(known, p[np.arange(n), best], 0.0))],
                names=["doc_id", "held_out", "lang_pred", "score"])

    return run


def predict(docs: DataFrame, net: ByteNet | None) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    sent = docs.sparkSession.sparkContext.broadcast(net)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out(F.col("doc_id")).alias("held_out"))
    return d.mapInArrow(_predict(sent), "doc_id long, held_out boolean, lang_pred string, score double")


def report(docs: DataFrame) -> DataFrame:
    return predict(docs, train(docs))
