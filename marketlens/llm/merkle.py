"""Merkle manifest of a dataset: a root over all rows, one proof a row, and the check of a tampered copy.

A row is a leaf, the hash of its fields; the leaves of a source, by doc_id, and then
the sources' roots are folded by runs of ``RUN`` up to one root.  A node stays on the
row of its first leaf: at a level the siblings of a node are ``RUN ** level`` rows
away, so lag and lead columns of fixed offsets, masked by the node's place in its run
and by the number of nodes, supply them; rows of first children hash the parents.

Groups of ``RUN ** LEVELS`` neighbouring rows are folded by windows of one
partitioning and one sort order, whatever the size of a source; the tops of the
groups are the nodes of the next round, which is that many times smaller.  Texts are
read once and never shuffled: rows travel as hashes.  Slots come from a range sort,
written down before anything depends on them.

Defined results: a null field is hashed as ``-``; a null source is a source of its own
and comes first; rows of one source with equal doc_id (null first) are ordered by
their leaf, and equal rows are leaves beside each other; a null doc_id is never
tampered with; a lone row has no siblings, and its proof is the hash of nothing; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.common import stored

#: Nodes under a parent, and levels that one round of windows folds (2187 rows a group).
RUN, LEVELS = 3, 7
SPAN = RUN ** LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _hash(*parts) -> Column:
    return F.sha2(F.concat(*parts), 256)


def encoded(value: Column) -> Column:
    """A field as it is hashed: its length in bytes, a colon and its text; ``-`` for null."""
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf(**replaced: Column) -> Column:
    return _hash(*[encoded(replaced.get(c, F.col(c))) for c in FIELDS])


def leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, source, leaf, tampered): ``tampered`` is the leaf of the changed row, null where none changed."""
    touched = (F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & F.col("text").contains("\n")
    changed = F.when(touched, leaf(text=F.replace(F.col("text"), F.lit("\n"), F.lit(""))))
    return docs.select("doc_id", "source", leaf().alias("leaf"), changed.alias("tampered"))


def numbered(rows: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """``rows`` with their slot in their tree and the tree's size ``n``, and the largest size.

    ``rows`` have a ``tree`` struct; ``order`` starts with what the tree is named by.  A
    range sort deals rows of one tree over many tasks; row numbers of a task and the
    counts of the tasks before it add up to slots.
    """
    ties = rows.withColumn("tie", F.monotonically_increasing_id())
    ties = stored(ties, "merkle_rows", "zstd")
    placed = (ties.repartitionByRange(*order, "tie").sortWithinPartitions(*order, "tie").drop("tie")
              .withColumn("at", F.monotonically_increasing_id()))
    placed = stored(placed, "merkle_order", "zstd").withColumn("task", F.shiftright("at", 33))
    counts = placed.groupBy("tree", "task").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    tree = Window.partitionBy("tree")
    before = F.sum("rows").over(tree.orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    starts = stored(counts.select("tree", "task", (F.col("first") - F.coalesce(before, F.lit(0))).alias("start"),
                                  F.sum("rows").over(tree).alias("n")), "merkle_starts")
    largest = starts.agg(F.max("n").alias("n")).first().n or 0
    slots = placed.join(starts, ["tree", "task"]).withColumn("slot", F.col("at") - F.col("start"))
    return slots.drop("at", "task", "start"), largest


def climbed(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Fold ``nodes`` (tree, slot, n, h, ...) by ``LEVELS`` levels.

    Returns the rows with their ``group`` and ``steps`` (siblings to the left and to the
    right, level by level), and the groups' tops as nodes of the next round.
    """
    rows = nodes.withColumns({"group": F.expr(f"slot div {SPAN}"), "h0": F.col("h")})
    w = Window.partitionBy("tree", "group").orderBy("slot")
    for level in range(LEVELS):
        gap, h = RUN ** level, F.col(f"h{level}")
        rows = rows.withColumns({f"{side}{k}": move(h, k * gap).over(w)
                                 for side, move in (("lag", F.lag), ("lead", F.lead)) for k in range(1, RUN)})
        place = F.expr(f"slot div {gap}") % RUN
        here = F.col("slot") % gap == 0
        several = F.col("n") > gap                       # nodes of this level are still to be folded
        none = F.lit("")
        left = F.concat(*[F.when(place >= k, F.col(f"lag{k}")).otherwise(none) for k in range(RUN - 1, 0, -1)])
        right = F.concat(*[F.coalesce(F.when(place + k < RUN, F.col(f"lead{k}")), none) for k in range(1, RUN)])
        rows = rows.withColumns({f"step{level}": F.when(here & several, F.struct(left.alias("left"), right.alias("right"))),
                                 f"h{level + 1}": F.when(here & (place == 0),
                                                         F.when(several, _hash(h, right)).otherwise(h))})
        rows = rows.drop(*[f"{side}{k}" for side in ("lag", "lead") for k in range(1, RUN)])
    tops = rows.filter(F.col("slot") % SPAN == 0).select(
        "tree", F.col("group").alias("slot"), F.ceil(F.col("n") / SPAN).cast("long").alias("n"),
        F.col(f"h{LEVELS}").alias("h"))
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)     # the nearest row before stands for the node
    steps = F.array_compact(F.array(*[F.last(f"step{level}", ignorenulls=True).over(upto) for level in range(LEVELS)]))
    own = [F.col(c) for c in nodes.columns]
    return rows.select(*own, "group", steps.alias("steps")), tops


def with_paths(nodes: DataFrame, largest: int) -> DataFrame:
    """``nodes`` with ``steps`` up to the top of their tree, and that ``top``."""
    rows, tops = climbed(nodes)
    return _joined(rows, above(tops, largest)).drop("group")


def above(tops: DataFrame, largest: int) -> DataFrame:
    """(tree, group, above, top) of groups of the round before: steps from a group's top to the tree's top."""
    tops = stored(tops, "merkle_tops", "zstd")
    if largest <= SPAN:                                  # one group a tree
        none = F.array().cast("array<struct<left:string,right:string>>")
        return tops.select("tree", F.col("slot").alias("group"), none.alias("above"), F.col("h").alias("top"))
    upper = with_paths(tops, -(-largest // SPAN))
    return stored(upper.select("tree", F.col("slot").alias("group"), F.col("steps").alias("above"), "top"),
                  "merkle_above", "zstd")


def _joined(rows: DataFrame, up: DataFrame) -> DataFrame:
    return (rows.join(up, ["tree", "group"]).withColumn("steps", F.concat("steps", "above")).drop("above"))


def manifest(docs: DataFrame) -> DataFrame:
    """One row per document: its leaf, the roots, its proof, and what a tampered copy's leaf folds to."""
    rows = leaves(docs).withColumn("tree", F.struct("source"))
    slots, largest = numbered(rows, ["source", "doc_id", "leaf"])
    folded, tops = climbed(slots.withColumn("h", F.col("leaf")))
    groups = above(tops, largest)
    subroots = groups.filter("group = 0").select(F.col("tree").alias("of"), F.col("top").alias("h"))
    sources = subroots.select(F.struct(F.lit(0).alias("all")).alias("tree"), F.col("of.source").alias("source"), "of", "h")
    source_slots, n_sources = numbered(sources, ["source"])
    roots = with_paths(source_slots, n_sources).select(
        F.col("of").alias("tree"), F.col("steps").alias("to_root"), F.col("top").alias("root"))
    up = groups.join(roots, "tree").select("tree", "group", F.concat("above", "to_root").alias("above"),
                                           F.col("top").alias("subroot"), "root")
    out = _joined(folded, up)
    proof = F.array_join(F.transform("steps", lambda x: F.concat(x["left"], x["right"])), "")
    fold = F.aggregate("steps", F.coalesce("tampered", "leaf"), lambda h, x: _hash(x["left"], h, x["right"]))
    return (out.select("doc_id", "leaf", "subroot", "root", F.sha2(proof, 256).alias("proof_sha256"),
                       fold.alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


#: Fixed value: the reversed CRC-32 polynomial.
_CRC_POLYNOMIAL = 0xEDB88320


def manifest_sql() -> str:
    """The same result in DuckDB SQL: levels and proofs by recursion over the tree."""
    enc = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    node = lambda text: "sha256(" + " || ".join(enc(c if c != "text" else text) for c in FIELDS) + ")"
    bit = f"CASE WHEN c & 1 = 1 THEN xor(c >> 1, {_CRC_POLYNOMIAL}) ELSE c >> 1 END"
    byte = f"list_reduce(list_prepend(xor(c, ascii(ch)::BIGINT), [0::BIGINT FOR i IN range(8)]), lambda c, i: {bit})"
    # the digits travel as numbers behind the starting value, one byte folded after the other
    crc = byte.replace("ascii(ch)::BIGINT", "d")
    return f"""WITH RECURSIVE docs AS (
  SELECT *, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
                                     lambda ch: ascii(ch)::BIGINT)), lambda c, d: {crc}) AS crc FROM documents),
leaves AS (
  SELECT doc_id, source, leaf, CASE WHEN doc_id IS NOT NULL AND xor(crc, 4294967295) % 2 = 0 THEN tampered ELSE leaf END AS start,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS slot,
         count(*) OVER (PARTITION BY source) AS n, row_number() OVER () AS id
  FROM (SELECT *, {node('text')} AS leaf, {node("replace(text, chr(10), '')")} AS tampered FROM docs)),
up AS (
  SELECT 0 AS level, source, slot, n, leaf AS h FROM leaves
  UNION ALL
  SELECT level + 1, source, slot // {RUN}, (n + {RUN - 1}) // {RUN}, sha256(string_agg(h, '' ORDER BY slot))
  FROM up WHERE n > 1 GROUP BY level, source, n, slot // {RUN}),
subroots AS (SELECT source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS slot, count(*) OVER () AS n
             FROM up WHERE n = 1),
top AS (
  SELECT 0 AS level, slot, n, h FROM subroots
  UNION ALL
  SELECT level + 1, slot // {RUN}, (n + {RUN - 1}) // {RUN}, sha256(string_agg(h, '' ORDER BY slot))
  FROM top WHERE n > 1 GROUP BY level, n, slot // {RUN}),
runs AS (SELECT level, source, slot // {RUN} AS run, list(h ORDER BY slot) AS hs FROM up WHERE n > 1
         GROUP BY level, source, slot // {RUN}),
top_runs AS (SELECT level, slot // {RUN} AS run, list(h ORDER BY slot) AS hs FROM top WHERE n > 1
             GROUP BY level, slot // {RUN}),
low_path AS (
  SELECT id, source, 0 AS level, slot, n, '' AS proof, start AS folded FROM leaves
  UNION ALL
  SELECT id, p.source, p.level + 1, slot // {RUN}, (n + {RUN - 1}) // {RUN},
         proof || list_aggregate(hs[:slot % {RUN}] || hs[slot % {RUN} + 2:] || [''], 'string_agg', ''),
         sha256(list_aggregate(hs[:slot % {RUN}] || [folded] || hs[slot % {RUN} + 2:], 'string_agg', ''))
  FROM low_path p JOIN runs r ON r.level = p.level AND r.source IS NOT DISTINCT FROM p.source AND r.run = slot // {RUN}
  WHERE n > 1),
high_path AS (
  SELECT id, 0 AS level, s.slot, s.n, proof, folded, s.h AS subroot
  FROM low_path p JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source WHERE p.n = 1
  UNION ALL
  SELECT id, p.level + 1, slot // {RUN}, (n + {RUN - 1}) // {RUN},
         proof || list_aggregate(hs[:slot % {RUN}] || hs[slot % {RUN} + 2:] || [''], 'string_agg', ''),
         sha256(list_aggregate(hs[:slot % {RUN}] || [folded] || hs[slot % {RUN} + 2:], 'string_agg', '')), subroot
  FROM high_path p JOIN top_runs r ON r.level = p.level AND r.run = slot // {RUN} WHERE n > 1)
SELECT l.doc_id, l.leaf, p.subroot, t.h AS root, sha256(p.proof) AS proof_sha256, p.folded AS folded_root,
       p.folded = t.h AS verified
FROM high_path p JOIN leaves l USING (id) JOIN (SELECT h FROM top WHERE n = 1) t ON true WHERE p.n = 1"""
