"""Ranked lexical search: documents grouped by the terms of an item that they hold.

One pass over the texts keeps, per document, its number of terms and the
occurrences of the items' terms; the corpus counts (documents, terms, documents per
term) are summed on the way.  A second pass takes up blocks of documents: for each item
the presence bits of its terms are or-ed into one mask a document, documents of equal
masks form a group, and no document of a group can score above the sum of its
terms' best scores in the block.  Groups are scored exactly in descending order of
that bound until the bound falls below the tenth score found.  Blocks pass on ten
rows an item.

Items are the stated query set: they are taken up in blocks of ``ITEMS``, each with
its own passes over all documents, so what tasks and driver hold (the block's terms
and their counts) is bounded by the items and never grows with the documents.

Defined results: null and empty texts have no terms, and an item without terms no
rows; terms that no document holds add nothing; every row of documents counts as a
document of its own, a null doc_id ranks after others of its score; every row of
items is ranked by itself, repeated item_ids included; a weight of 0 adds nothing; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.common import slices, stored, through_arrow

#: Results of an item, items of a pass, documents of a block, groups scored at once.
TOP, ITEMS, BLOCK, STEP = 10, 4096, 16384, 64
#: Longer texts are split into terms bit by bit.
LONG = 1 << 22
#: Maximal runs of ASCII digits and letters and of bytes above ASCII: the same terms as in code points.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Fixed values of the score.
SCALE, BASE, SLOPE = 1_000_000_000, 25, 75


def terms(text: str | None) -> Iterator[bytes]:
    """The text's terms; ``bytes.lower`` lowers A-Z alone."""
    raw = (text or "").encode("utf-8", "surrogatepass").lower()
    return iter(TERM.findall(raw)) if len(raw) <= LONG else (m.group() for m in TERM.finditer(raw))


_HITS = "doc_id long, n long, terms array<int>, tfs array<long>, df array<long>"


def hits(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Per document its length and hits; a task's last row has the task's documents per term instead."""

    def task(batches):
        held = np.zeros(len(vocabulary), np.int64)
        for batch in slices(batches):
            lens, ids, tfs, ends = [], [], [], [0]
            for text in batch.column(1):
                found = Counter(terms(text.as_py()))
                lens.append(sum(found.values()))
                own = sorted((vocabulary[t], k) for t, k in found.items() if t in vocabulary)
                ids += [i for i, _ in own]
                tfs += [k for _, k in own]
                ends.append(len(ids))
            np.add.at(held, ids, 1)
            yield _hits_batch(batch.column(0), lens, ids, tfs, ends, pa.nulls(len(lens), pa.list_(pa.int64())))
        yield _hits_batch(pa.nulls(1, pa.int64()), [0], [], [], [0, 0], pa.array([held], pa.list_(pa.int64())))

    return stored(through_arrow(docs.select("doc_id", "text"), task, _HITS), "lexical_hits", "zstd")


def _hits_batch(doc_ids, lens, ids, tfs, ends, df) -> pa.RecordBatch:
    at = pa.array(ends, pa.int32())
    lists = [pa.ListArray.from_arrays(at, pa.array(v, t)) for v, t in ((ids, pa.int32()), (tfs, pa.int64()))]
    return pa.RecordBatch.from_arrays([doc_ids, pa.array(lens, pa.int64()), *lists, df], names=["doc_id", "n", "terms", "tfs", "df"])


class Block:
    """Documents of a block and the scores of their hits, by term."""

    def __init__(self, batches: list[pa.RecordBatch], weights: np.ndarray, n_docs: int, n_terms: int):
        table = pa.Table.from_batches(batches)
        self.ids = table.column(0).combine_chunks()
        n = table.column(1).to_numpy()
        lists = table.column(2).combine_chunks()
        doc = np.repeat(np.arange(len(n)), np.diff(lists.offsets.to_numpy()))
        term = lists.flatten().to_numpy()
        tf = table.column(3).combine_chunks().flatten().to_numpy()
        by_term = np.argsort(term, kind="stable")                       # documents stay ascending within a term
        self.doc, tf = doc[by_term], tf[by_term]
        m = BASE + SLOPE * n * n_docs // n_terms
        self.score = (SCALE * tf) // (1000 * tf + 8 * m[self.doc]) * weights[term[by_term]]
        self.start = np.searchsorted(term[by_term], np.arange(len(weights) + 1))
        # equal scores go by doc_id, nulls last: documents in the order in which they win ties
        ids = self.ids.fill_null(0).to_numpy()
        self.tie = np.empty(len(n), np.int64)
        self.tie[np.lexsort((ids, self.ids.is_null().to_numpy(zero_copy_only=False)))] = np.arange(len(n))

    def masks(self, own: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Documents with a term of ``own``, and their presence bits, 64 terms a word."""
        words = np.zeros((len(self.tie), -(-len(own) // 64)), np.uint64)
        for bit, t in enumerate(own):
            words[self.doc[self.start[t]:self.start[t + 1]], bit // 64] |= np.uint64(1 << bit % 64)
        docs = np.flatnonzero(words.any(axis=1))
        return docs, words[docs]

    def exact(self, docs: np.ndarray, own: list[int], times: np.ndarray) -> np.ndarray:
        total = np.zeros(len(docs), np.int64)
        for t, k in zip(own, times):
            held = self.doc[self.start[t]:self.start[t + 1]]
            at = np.searchsorted(held, docs)
            found = at < len(held)
            found[found] = held[at[found]] == docs[found]
            total[found] += k * self.score[self.start[t] + at[found]]
        return total

    def best(self, item: Counter) -> tuple[np.ndarray, np.ndarray]:
        """The documents with the ``TOP`` highest scores above 0, and these scores."""
        own = [t for t in item if self.start[t] < self.start[t + 1]]
        times = np.array([item[t] for t in own], np.int64)
        none = np.zeros(0, np.int64)
        if not own:
            return none, none
        docs, words = self.masks(own)
        groups, of = np.unique(words, axis=0, return_inverse=True) if words.shape[1] > 1 else \
            np.unique(words[:, 0], return_inverse=True)
        most = times * np.array([self.score[self.start[t]:self.start[t + 1]].max() for t in own])
        groups = groups.reshape(len(groups), -1)
        bound = sum(most[b] * (groups[:, b // 64] >> np.uint64(b % 64) & np.uint64(1)).astype(np.int64)
                    for b in range(len(own)))
        by_bound = np.argsort(-bound, kind="stable")
        place = np.empty(len(groups), np.int64)
        place[by_bound] = np.arange(len(groups))
        in_order = np.argsort(place[of.ravel()], kind="stable")           # documents, best groups first
        ends = np.cumsum(np.bincount(place[of.ravel()], minlength=len(groups)))
        top, scores, done, step = none, none, 0, STEP
        while done < len(groups) and (len(top) < TOP or bound[by_bound[done]] >= scores[-1]):
            upto = min(done + step, len(groups))
            more = docs[in_order[ends[done - 1] if done else 0:ends[upto - 1]]]
            top, scores = np.r_[top, more], np.r_[scores, self.exact(more, own, times)]
            order = np.lexsort((self.tie[top], -scores))[:TOP]
            order = order[scores[order] > 0]
            top, scores = top[order], scores[order]
            done, step = upto, 2 * step
        return top, scores


_FOUND = "item int, doc_id long, score long"


def ranked(found: DataFrame, items: list[tuple[int, Counter]], weights: np.ndarray, n_docs: int, n_terms: int) -> DataFrame:
    """Every item's best documents of each block: (item, doc_id, score)."""

    def rows(batches):
        block = Block(batches, weights, n_docs, n_terms)
        out = [(nth, *block.best(item)) for nth, item in items]
        at = np.concatenate([top for _, top, _ in out])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat([nth for nth, _, _ in out], [len(top) for _, top, _ in out]), pa.int32()),
             block.ids.take(pa.array(at, pa.int64())), pa.array(np.concatenate([s for _, _, s in out]), pa.int64())],
            names=["item", "doc_id", "score"])

    def task(batches):
        held, size = [], 0
        for batch in batches:
            for k in range(0, batch.num_rows, BLOCK):
                piece = batch.slice(k, BLOCK)
                if size + piece.num_rows > BLOCK:
                    yield rows(held)
                    held, size = [], 0
                held, size = [*held, piece], size + piece.num_rows
        if size:
            yield rows(held)

    return through_arrow(found.filter("df IS NULL").select("doc_id", "n", "terms", "tfs"), task, _FOUND)


def weight(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)


def search_block(docs: DataFrame, texts: list[str | None]) -> DataFrame:
    """(item, rank, doc_id, score) for one block of items' texts, ``item`` being their position."""
    spark = docs.sparkSession
    counted = [Counter(terms(t)) for t in texts]
    vocabulary = {t: i for i, t in enumerate(sorted({t for c in counted for t in c}))}
    found = hits(docs, vocabulary)
    n_docs, n_terms = found.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not n_terms or not vocabulary:
        return spark.createDataFrame([], "item int, rank int, doc_id long, score long")
    held = found.filter("df IS NOT NULL").select(F.posexplode("df").alias("term", "k")).filter("k > 0")
    df = np.zeros(len(vocabulary), np.int64)
    for r in held.groupBy("term").agg(F.sum("k").alias("k")).toLocalIterator():      # the items' terms
        df[r.term] = r.k
    items = [(i, Counter({vocabulary[t]: k for t, k in c.items()})) for i, c in enumerate(counted) if c]
    best = stored(ranked(found, items, weight(n_docs, df), n_docs, n_terms), "lexical_best")
    # ten rows of every block an item: cut once among parts of the blocks, then over all
    part = F.pmod(F.xxhash64("doc_id", "score"), F.lit(64))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    rank = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    best = best.withColumn("part", part).withColumn("rank", rank("item", "part")).filter(F.col("rank") <= TOP)
    return (best.withColumn("rank", rank("item")).filter(F.col("rank") <= TOP)
            .select("item", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))


def search(docs: DataFrame, items: DataFrame, block: int = ITEMS) -> DataFrame:
    """Each item's ``TOP`` best documents: item_id, rank, doc_id, score."""
    asked = stored(items.select("item_id", "text").withColumn("at", F.monotonically_increasing_id()), "lexical_items")
    out, held = [], []

    def ranked_block():
        names = docs.sparkSession.createDataFrame([(i, r.item_id) for i, r in enumerate(held)], "item int, item_id long")
        found = search_block(docs, [r.text for r in held])
        out.append(found.join(names, "item").select("item_id", "rank", "doc_id", "score"))

    for row in asked.orderBy("item_id", "at").toLocalIterator():         # the query set, a block at a time
        held.append(row)
        if len(held) == block:
            ranked_block()
            held = []
    if held or not out:
        ranked_block()
    result = out[0]
    for more in out[1:]:
        result = result.unionByName(more)
    return result


def search_sql() -> str:
    """The same result in DuckDB SQL, scoring every document that holds a term."""
    split = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), " \
            r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return f"""WITH items AS (SELECT row_number() OVER () AS item, item_id, {split} AS ts FROM benchmark),
asked AS (SELECT item, item_id, t, count(*) AS k FROM (SELECT item, item_id, unnest(ts) AS t FROM items) GROUP BY ALL),
docs AS (SELECT row_number() OVER () AS row, doc_id, {split} AS ts FROM documents),
sizes AS (SELECT row, doc_id, CAST(len(ts) AS BIGINT) AS n FROM docs WHERE len(ts) > 0),
corpus AS (SELECT count(*) AS all_docs, CAST(sum(n) AS BIGINT) AS all_terms FROM sizes),
tfs AS (SELECT row, t, count(*) AS tf FROM (SELECT row, unnest(ts) AS t FROM docs) GROUP BY ALL),
weights AS (SELECT t, CAST(floor(1000 * ln((2 * all_docs + 2) / (2 * df + 1))) AS BIGINT) AS w
            FROM (SELECT t, count(*) AS df FROM tfs GROUP BY t), corpus),
scored AS (SELECT item, item_id, row, doc_id,
                  CAST(sum(k * w * (({SCALE} * tf) // (1000 * tf + 8 * ({BASE} + ({SLOPE} * n * all_docs) // all_terms))))
                       AS BIGINT) AS score
           FROM asked JOIN weights USING (t) JOIN tfs USING (t) JOIN sizes USING (row), corpus GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank
      FROM scored WHERE score > 0) WHERE rank <= {TOP}"""
