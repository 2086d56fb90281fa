"""Chat formatting of maximal conversations: logged snapshots that a longer log contains are collapsed.

A log's prefix up to a turn is known by its number of turns and two sums of
hashes of (turn, role, text), rolled forward turn by turn.  A log whose whole is
a proper prefix of another one is dropped by an anti-join on these keys; of
equal logs the least conv_id stays.  What remains is rendered.

Only DataFrame functions run here.  Sums roll within segments of ``SEGMENT``
turns and segment totals are carried on, so a conversation that holds a third of
all rows is many tasks if its turns are numbered apart (rows of one segment, null
turns for instance, are one text by definition and meet in one task); prefix keys are made distinct before they are joined,
so a first turn that many logs share is one row.

Defined results: turn numbers belong to a log's identity; rows of one turn have
no order among themselves but are rendered by role, then text; repeated rows are
repeated turns; a null turn comes first, a null role renders as ``unknown`` and
null text as empty; null conv_id is one conversation; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.common import stored

#: Turns that are rolled and rendered together.
SEGMENT = 1024
#: The marks around a turn, and how their opening is written inside a text.
OPEN, CLOSE, MARK, MARK_IN_TEXT = "<|im_start|>", "<|im_end|>", "<|", "< |"


def _big(x: Column) -> Column:
    return x.cast("decimal(38,0)")


def rendered(role: Column, text: Column) -> Column:
    """One turn: marks around the role, a line end and the text."""
    clean = lambda x, other: F.replace(F.coalesce(x, F.lit(other)), F.lit(MARK), F.lit(MARK_IN_TEXT))
    return F.concat(F.lit(OPEN), clean(role, "unknown"), F.lit("\n"), clean(text, ""), F.lit(CLOSE), F.lit("\n"))


def _segment(turn: Column) -> Column:
    return F.floor(turn / SEGMENT).cast("long")


def prefixes(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Keys of every log's proper prefixes (distinct), and every log's own key: (conv_id, n, h1, h2)."""
    t = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    row = (F.col("turn"), F.col("role"), F.col("text"), F.isnull("role"), F.isnull("text"))
    t = t.select("conv_id", "turn", _segment(F.col("turn")).alias("seg"),
                 _big(F.xxhash64(F.lit(1), *row)).alias("h1"), _big(F.xxhash64(F.lit(2), *row)).alias("h2"))
    sums = [F.sum("h1").alias("h1"), F.sum("h2").alias("h2")]
    by_turn = t.groupBy("conv_id", "seg", "turn").agg(F.count(F.lit(1)).alias("n"), *sums)
    by_turn = stored(by_turn, "chat_turns")
    by_seg = by_turn.groupBy("conv_id", "seg").agg(F.sum("n").alias("n"), *sums)
    log = Window.partitionBy("conv_id")
    earlier = log.orderBy(F.col("seg").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    carried = by_seg.select(
        F.struct("conv_id", "seg").alias("at"), F.sum("n").over(log).alias("total"),
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("n", "h1", "h2")])
    upto = Window.partitionBy("at").orderBy(F.col("turn").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    rolled = by_turn.select(F.struct("conv_id", "seg").alias("at"), "turn", "n", "h1", "h2")
    rolled = (rolled.select("at", *[F.sum(c).over(upto).alias(c) for c in ("n", "h1", "h2")])
              .join(carried, "at")
              .select("total", (F.col("n") + F.col("n_before")).alias("n"),
                      *[_big(F.col(c) + F.col(f"{c}_before")).alias(c) for c in ("h1", "h2")]))
    proper = rolled.filter("n < total").select("n", "h1", "h2").distinct()
    whole = (by_seg.groupBy("conv_id").agg(F.sum("n").alias("n"), *[_big(F.sum(c)).alias(c) for c in ("h1", "h2")]))
    return proper, whole


def maximal(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_copies) of the logs that no other log contains as a prefix."""
    proper, whole = prefixes(turns)
    one = whole.groupBy("n", "h1", "h2").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_copies"))
    return (one.join(proper, ["n", "h1", "h2"], "left_anti")
            .select("conv_id", F.col("n").alias("n_turns"), "n_copies"))


def render(turns: DataFrame) -> DataFrame:
    """One row per kept conversation and segment of turns: conv_id, part, n_turns, n_copies, chat.

    A conversation's whole text is its parts in order; up to ``SEGMENT`` turns are one part, numbered 0.
    """
    kept = stored(maximal(turns), "chat_kept").select(F.struct("conv_id").alias("log"), "n_turns", "n_copies")
    rows = turns.select(F.struct("conv_id").alias("log"), F.col("turn").cast("long").alias("turn"), "role", "text")
    line = F.struct("turn", "role", "text")
    parts = (rows.join(kept, "log").groupBy("log", _segment(F.col("turn")).alias("seg"))
             .agg(F.first("n_turns").alias("n_turns"), F.first("n_copies").alias("n_copies"),
                  F.sort_array(F.collect_list(line)).alias("lines")))
    chat = F.array_join(F.transform("lines", lambda x: rendered(x["role"], x["text"])), "")
    return parts.select("log.conv_id", F.coalesce("seg", F.lit(0)).alias("part"), "n_turns", "n_copies", chat.alias("chat"))


def render_sql() -> str:
    """The same result in DuckDB SQL, by comparing whole logs turn by turn."""
    clean = lambda x, other: f"replace(coalesce({x}, '{other}'), '{MARK}', '{MARK_IN_TEXT}')"
    return f"""WITH t AS (SELECT conv_id, turn, role, text, struct_pack(t := turn, r := role, x := text) AS line
           FROM conversations),
logs AS (SELECT conv_id, max(turn) AS last, count(*) AS n_turns,
                list(line ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS lines FROM t GROUP BY conv_id),
longer AS (SELECT DISTINCT s.conv_id FROM logs s JOIN logs l ON l.n_turns > s.n_turns AND l.lines[1] = s.lines[1]
           WHERE l.lines[1:s.n_turns] = s.lines AND l.lines[s.n_turns + 1].t IS DISTINCT FROM s.last),
kept AS (SELECT min(conv_id) AS conv_id, any_value(n_turns) AS n_turns, count(*) AS n_copies, lines
         FROM logs ANTI JOIN longer ON logs.conv_id IS NOT DISTINCT FROM longer.conv_id GROUP BY lines)
SELECT kept.conv_id, coalesce(CAST(floor(turn / {SEGMENT}) AS BIGINT), 0) AS part, any_value(n_turns) AS n_turns,
       any_value(n_copies) AS n_copies,
       string_agg('{OPEN}' || {clean('role', 'unknown')} || chr(10) || {clean('text', '')} || '{CLOSE}' || chr(10), ''
                  ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS chat
FROM t JOIN kept ON t.conv_id IS NOT DISTINCT FROM kept.conv_id GROUP BY kept.conv_id, floor(turn / {SEGMENT})"""
