"""Approximate nearest neighbours by learned partitions.

A bounded sample of different vectors becomes a neighbour graph, which recursive
bisection (at the median of a smooth vector on the graph) cuts into equal parts.
A small network learns which parts a vector's neighbours lie in.  Every row is
indexed in its most probable part; a query visits its most probable parts, as
many as hold ``SAMPLE_RECALL`` of the true neighbours of the sample's fifth that
graph, parts and network haven't seen, and the rows found are ranked by their
exact inner product.

The number of parts follows the number of different vectors (``PART_ROWS`` each,
from ``LEAST_PARTS`` up to ``MAX_PARTS``), and the sample the number of parts.  Neighbours of
the sample are found in Spark tasks; the driver holds the sample, its graph and
the network.  Rows and queries of one part meet in blocks of bounded size, so a
part that holds a third of all rows, or of all queries, is many tasks.

Defined results: vectors null, zero, with null or non-finite components, or of
another length than most take no part, nor do rows without vec_id; equal rows
count once; rows that share the query's vec_id aren't its candidates; ties go to
the smaller vec_id; fewer than ``LEAST_VECTORS`` different vectors are one part; an
empty table gives no rows; extra columns are ignored.  Vectors of floats stay
floats, those of other numbers are taken as doubles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from marketlens.llm.common import stored

TOP = 20
#: Different vectors that a part should hold, the least and most parts, and sample rows for each part.
PART_ROWS, LEAST_PARTS, MAX_PARTS, SAMPLE_PER_PART = 8192, 32, 1024, 512
#: Fewer different vectors than this are not cut into parts.
LEAST_VECTORS = 256
#: Sample rows held out (one in so many), and the share of their true neighbours that the visited parts must hold.
HELD_OUT = 5
SAMPLE_RECALL = 0.95
NEIGHBOURS, HIDDEN, EPOCHS, RATE, SEED = 10, 128, 40, 0.01, 11
#: Rows, and queries, that meet in one task group at most (on average over hash blocks).
BLOCK_ROWS, BLOCK_QUERIES = 8192, 2048
#: Inner products that a task of the sample's graph holds at once, and computes in all.
HELD_PRODUCTS, TASK_PRODUCTS = 1 << 24, 1 << 28


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id long, vec array of float or double): distinct rows whose vectors can take part."""
    floats = vectors.schema["embedding"].dataType.elementType == FloatType()
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                       F.col("embedding").cast("array<float>" if floats else "array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    v = v.filter(F.col("vec_id").isNotNull() & F.col("vec").isNotNull())
    v = v.filter(finite & F.exists("vec", lambda x: x != 0))
    length = v.groupBy(F.size("vec").alias("k")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("k")).first()
    v = v.filter(F.size("vec") == (length.k if length else 0))
    return stored(v.dropDuplicates(["vec_id", "vec"]), "ann_vectors")


def neighbour_graph(x: np.ndarray, k: int, rows: np.ndarray | None = None, among: int | None = None) -> np.ndarray:
    """For each of ``rows`` (all): the k others of largest inner product among x's first rows, nearest first."""
    rows = np.arange(len(x)) if rows is None else rows
    among = len(x) if among is None else among
    out = np.empty((len(rows), k), np.int64)
    step = max(1, HELD_PRODUCTS // among)
    for a in range(0, len(rows), step):
        own = rows[a:a + step]
        s = x[own] @ x[:among].T
        known = np.flatnonzero(own < among)
        s[known, own[known]] = -np.inf
        near = np.argpartition(-s, k - 1, axis=1)[:, :k]
        out[a:a + step] = np.take_along_axis(near, np.argsort(-np.take_along_axis(s, near, 1), axis=1), 1)
    return out


def _graph_task(sent, k: int, among: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = neighbour_graph(sent.value, k, batch.column(0).to_numpy(), among)
            ends = np.arange(0, near.size + 1, k, dtype=np.int32)
            lists = pa.ListArray.from_arrays(ends, pa.array(near.ravel(), pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["id", "near"])

    return run


def sample_graph(spark: SparkSession, x: np.ndarray, k: int, among: int) -> np.ndarray:
    """``neighbour_graph`` of a sample, its rows dealt to tasks."""
    sent = spark.sparkContext.broadcast(x)      # MAX_PARTS * SAMPLE_PER_PART vectors at most
    tasks = -(-len(x) * among // TASK_PRODUCTS)
    found = (spark.range(0, len(x), 1, tasks).mapInArrow(_graph_task(sent, k, among), "id long, near array<int>")
             .toArrow().sort_by("id"))
    return _matrix(found["near"], np.int64)


def balanced_parts(graph: np.ndarray, parts: int) -> np.ndarray:
    """A part for each node; sizes differ by one at most per halving, few edges are cut."""
    rng = np.random.default_rng(SEED)
    n = len(graph)
    label, groups = np.zeros(n, np.int64), [np.arange(n)]
    a, b = np.repeat(np.arange(n), graph.shape[1]), graph.ravel()
    a, b = np.concatenate([a, b]), np.concatenate([b, a])
    while len(groups) < parts:
        place, halves = np.empty(n, np.int64), []
        for g in groups:
            place[g] = np.arange(len(g))
            inside = (label[a] == label[g[0]]) & (label[b] == label[g[0]])
            u, v = place[a[inside]], place[b[inside]]
            degree = np.bincount(u, minlength=len(g)) + 1e-9
            vec = rng.normal(size=len(g))
            for _ in range(60):  # averaging over neighbours, the constant part taken off
                vec = (vec + np.bincount(u, weights=vec[v], minlength=len(g)) / degree) / 2
                vec -= np.average(vec, weights=degree)
                vec /= np.abs(vec).max() + 1e-30
            order = np.argsort(vec, kind="stable")
            halves += [g[order[:len(g) // 2]], g[order[len(g) // 2:]]]
        groups = halves
        for i, g in enumerate(groups):
            label[g] = i
    return label


class Router:
    """Two-layer network: vector -> probability of each part."""

    def __init__(self, dim: int, parts: int):
        rng = np.random.default_rng(SEED)
        self.w1 = rng.normal(0, dim ** -0.5, (dim, HIDDEN)) * 3
        self.b1 = np.zeros(HIDDEN)
        self.w2 = rng.normal(0, HIDDEN ** -0.5, (HIDDEN, parts))
        self.b2 = np.zeros(parts)
        self.visits = 1

    def scores(self, x: np.ndarray) -> np.ndarray:
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        return np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def train(self, x: np.ndarray, own: np.ndarray, near: np.ndarray) -> None:
        """Adam on the cross entropy with each row's parts: half its own, half those of its neighbours."""
        rng = np.random.default_rng(SEED)
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        params = [self.w1, self.b1, self.w2, self.b2]
        mean, square, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(x))
            for a in range(0, len(x), 256):
                rows = order[a:a + 256]
                xb, t = x[rows], np.zeros((len(rows), len(self.b2)))
                t[np.arange(len(rows)), own[rows]] = 0.5
                for column in near[rows].T:
                    t[np.arange(len(rows)), column] += 0.5 / near.shape[1]
                h = np.maximum(xb @ self.w1 + self.b1, 0)
                z = h @ self.w2 + self.b2
                p = np.exp(z - z.max(axis=1, keepdims=True))
                d = (p / p.sum(axis=1, keepdims=True) - t) / len(t)
                dh = (d @ self.w2.T) * (h > 0)
                step += 1
                for w, g, m, s in zip(params, (xb.T @ dh, dh.sum(0), h.T @ d, d.sum(0)), mean, square):
                    m += 0.1 * (g - m)
                    s += 0.001 * (g * g - s)
                    w -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)

    def ranked(self, x: np.ndarray, n: int) -> np.ndarray:
        return np.argsort(-self.scores(x), axis=1, kind="stable")[:, :n]


def fit(vectors: DataFrame, rows: int, top: int = TOP) -> Router:
    """A router trained on a sample of ``vectors`` (so many rows); its number of visits is set by rows held out."""
    if rows < LEAST_VECTORS:
        return Router(1, 1)
    h = F.xxhash64("vec")       # copies of one vector would be each other's only neighbours
    different = vectors.select(h).distinct().count()
    if different < LEAST_VECTORS:
        return Router(1, 1)
    parts = LEAST_PARTS
    while parts < MAX_PARTS and parts * PART_ROWS < different:
        parts *= 2
    size = parts * SAMPLE_PER_PART
    share = min(1.0, 1.5 * size / different)
    picked = vectors.filter(F.pmod(h, F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))).select(h.alias("h"), "vec")
    x = _matrix(picked.dropDuplicates(["vec"]).orderBy("h", "vec").limit(size).toArrow()["vec"], np.float32)
    held = np.arange(len(x)) % HELD_OUT == HELD_OUT - 1
    x, known = np.concatenate([x[~held], x[held]]), int((~held).sum())
    graph = sample_graph(vectors.sparkSession, x, min(max(NEIGHBOURS, top), known - 1), known)
    near = graph[:known, :NEIGHBOURS]
    label = balanced_parts(near, parts)
    router = Router(x.shape[1], parts)
    x = x.astype(np.float64)
    router.train(x[:known], label, label[near])
    found = held_out_shares(router, x[:known], x[known:], graph[known:, :top])
    router.visits = int(np.searchsorted(found, SAMPLE_RECALL) + 1)
    return router


def held_out_shares(router: Router, rows: np.ndarray, queries: np.ndarray, near: np.ndarray) -> np.ndarray:
    """Share of the queries' neighbours (row numbers) that lie in the first 1, 2, ... parts visited."""
    parts = len(router.b2)
    own = np.concatenate([router.ranked(rows[a:a + 4096], 1)[:, 0] for a in range(0, len(rows), 4096)])
    met = np.zeros(parts, np.int64)
    for a in range(0, len(queries), 4096):
        at = np.argsort(router.ranked(queries[a:a + 4096], parts), axis=1)   # by query: each part's position
        met += np.bincount(np.take_along_axis(at, own[near[a:a + 4096]], axis=1).ravel(), minlength=parts)
    return np.cumsum(met) / met.sum()


def _matrix(column, kind=np.float64) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


def _routed(sent, every: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        router = sent.value
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            if len(router.b2) == 1:
                parts = np.zeros((n, 1), np.int64)
            else:
                parts = router.ranked(_matrix(batch.column("vec")), router.visits)
            query = batch.column("vec_id").to_numpy() % every == 0
            visits = [p.tolist() if q else [] for p, q in zip(parts, query)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("vec"), pa.array(parts[:, 0], pa.int32()),
                 pa.array(visits, pa.list_(pa.int32()))], names=["vec_id", "vec", "part", "visits"])

    return run


def _nearest(top: int):
    names = ["query_id", "vec_id", "score"]
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        if not queries.num_rows or not rows.num_rows:
            return schema.empty_table()
        q, x = _matrix(queries["vec"]), _matrix(rows["row"])
        qid, ids = queries["query_id"].to_numpy(), rows["row_id"].to_numpy()
        out = [[], [], []]
        for a in range(0, len(q), 256):
            s = q[a:a + 256] @ x.T
            s[qid[a:a + 256, None] == ids[None, :]] = -np.inf
            k = min(top, s.shape[1]) - 1
            # a product by blocks may differ in the last digits: take what is near the limit, then be exact
            least = np.partition(s, s.shape[1] - 1 - k, axis=1)[:, s.shape[1] - 1 - k]
            for i, row in enumerate(s):
                near = np.flatnonzero((row >= least[i] - 1e-9 * (1 + abs(least[i]))) & (row > -np.inf))
                exact = (x[near] * q[a + i]).sum(axis=1)
                best = np.lexsort((ids[near], -exact))[:top]
                out[0].append(np.full(len(best), qid[a + i]))
                out[1].append(ids[near][best])
                out[2].append(exact[best])
        return pa.table([np.concatenate(c) for c in out], names=names).cast(schema)

    return run


def search(vectors: DataFrame, every: int, top: int = TOP) -> DataFrame:
    """The ``top`` nearest found for every row whose vec_id is divisible by ``every``: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    v = usable(vectors)
    sent = spark.sparkContext.broadcast(fit(v, v.count(), top))
    kind = v.schema["vec"].dataType.simpleString()
    routed = stored(v.mapInArrow(_routed(sent, every), f"vec_id long, vec {kind}, part int, visits array<int>"),
                    "ann_index")
    queries = routed.filter(F.size("visits") > 0).select(F.col("vec_id").alias("query_id"), "vec",
                                                         F.explode("visits").alias("part"))
    # one row per part, so MAX_PARTS rows at most
    blocks = (routed.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("row_blocks"))
              .join(queries.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / BLOCK_QUERIES).cast("int").alias("query_blocks")),
                    "part"))
    blocks = F.broadcast(stored(blocks, "ann_blocks"))
    pick = lambda n, c: F.pmod(F.xxhash64(c, F.lit(n)), F.col(n))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    q = (queries.join(blocks, "part").withColumn("qb", pick("query_blocks", "query_id").cast("int"))
         .select("part", "qb", spread("row_blocks").alias("rb"), "query_id", "vec"))
    x = (routed.join(blocks, "part").withColumn("rb", pick("row_blocks", "vec_id").cast("int"))
         .select(F.col("part").alias("own"), F.col("rb").alias("own_rb"), spread("query_blocks").alias("own_qb"),
                 F.col("vec_id").alias("row_id"), F.col("vec").alias("row")))
    found = (q.groupBy("part", "rb", "qb").cogroup(x.groupBy("own", "own_rb", "own_qb"))
             .applyInArrow(_nearest(top), "query_id long, vec_id long, score double"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (found.withColumn("rank", rank).filter(F.col("rank") <= top)
            .select("query_id", "rank", "vec_id", "score"))
