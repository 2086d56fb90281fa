"""Per-key sequential operators that stay balanced when one key is huge.

``LAG`` and a running ``MAX`` over ``PARTITION BY key ORDER BY t`` put every
row of a key into one task.  One symbol may hold a third of all ticks, so
both are computed in two levels instead:

1. rows are windowed by ``(key, segment)`` where ``segment`` is a coarse
   time bucket (a year of daily bars, an hour of ticks), which splits a hot
   key over many tasks;
2. a per-``(key, segment)`` aggregate (partial, so one row per key, segment
   and map task crosses the wire) gives each segment's last value / maximum;
   a window over that small table carries it to the next segment(s), and a
   join on ``(key, segment)`` patches the first row of each segment.  The
   rows are already hash-partitioned on ``(key, segment)`` by their window,
   so that join moves only the carry table (or broadcasts it, when AQE
   measures it small).

The result equals the one-level window (ties on the order key aside, which
have no defined order in either form); a NULL order value sorts first on every
path.  The rows are shuffled once and the source is read once: the carry table
is taken from the windowed rows, behind the same exchange.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SEG = "_seg"
_KEY = "_key"
SEGMENT_COLUMNS = (_KEY, _SEG)
# Segment id used for rows whose segment expression is NULL (they sort first).
_NULL_SEGMENT = -(2 ** 63)


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _order(order) -> list[str]:
    return [order] if isinstance(order, str) else list(order)


def _seg_rows(df: DataFrame, keys: list[str], order_cols: list[str], segment: Column | None):
    """Rows with the internal partition columns ``_key`` = struct(keys) and
    ``_seg``.  Both are never NULL (a struct is non-null even when its fields
    are, and struct equality matches NULL fields), so joins on them are plain
    equi-joins: no inferred IS NOT NULL filter, and no re-shuffle of rows that
    are already partitioned on them.

    ``segment=None`` reuses the columns (and the partitioning) an earlier
    segmented step kept with ``keep_segment=True``.
    """
    rows = df if segment is None else segmented_rows(df, keys, segment)
    w = Window.partitionBy(_KEY, _SEG).orderBy(*order_cols)
    return rows, w


def segmented_rows(df: DataFrame, key, segment: Column) -> DataFrame:
    """``df`` with its keys inside ``_key`` and its segment as ``_seg``."""
    keys = _keys(key)
    rest = [c for c in df.columns if c not in keys]
    return df.select(*rest, F.struct(*keys).alias(_KEY),
                     F.coalesce(segment.cast("long"), F.lit(_NULL_SEGMENT)).alias(_SEG))


def _carry_window(frame_end=None) -> Window:
    w = Window.partitionBy(_KEY).orderBy(_SEG)
    return w if frame_end is None else w.rowsBetween(Window.unboundedPreceding, frame_end)


def _patch(rows: DataFrame, carry: DataFrame) -> DataFrame:
    """Left equi-join of the rows with the per-segment carry table on
    (``_key``, ``_seg``).  The row side is already hash-partitioned on exactly
    these columns by its window, so a shuffle join moves only the carry side
    (one row per key and segment); AQE broadcasts it instead when small.
    """
    carry = carry.select(*[F.col(c).alias({_KEY: "_ck", _SEG: "_cs"}.get(c, c)) for c in carry.columns])
    cond = (F.col(_KEY) == F.col("_ck")) & (F.col(_SEG) == F.col("_cs"))
    return rows.join(carry, cond, "left")


def _same_exchange(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Keep every column of ``rows`` alive in a branch that needs few of them, so that
    both branches read one exchange (an always-true test of a row hash).  It holds as long
    as the row branch uses all columns: callers select what they need before."""
    return rows.filter(F.hash(*[F.col(c) for c in columns]) >= F.lit(-2 ** 31))


def _finished(rows: DataFrame, keys: list[str], base: list[str], out: Column, keep_segment: bool) -> DataFrame:
    """The caller's columns and ``out``; the segment columns too where a later step reuses the partitioning."""
    from_key = [F.col(f"{_KEY}.{k}").alias(k) for k in keys if k not in base]
    rest = [c for c in base if keep_segment or c not in SEGMENT_COLUMNS]
    return rows.select(*from_key, *rest, out)


def segmented_lag(df: DataFrame, key, order, value: str, segment: Column | None,
                  out: str, keep_segment: bool = False, shared: bool = True) -> DataFrame:
    """Add ``out`` = previous row's ``value`` within ``key`` ordered by ``order``.

    ``segment`` is an integer expression monotone in the order (e.g.
    ``year(date)``, ``unix_date(to_date(ts))``).  ``shared=False`` is for rows that
    are stored in buckets of the segment columns (``sources.bucketed``): with no exchange
    to share, the carry reads its own few columns from the table.
    """
    keys, order_cols = _keys(key), _order(order)
    rows, w = _seg_rows(df, keys, order_cols, segment)
    base = rows.columns
    # each segment's last value, carried to the next segment
    ends = rows.select(*base, F.lead(F.lit(1)).over(w).isNull().alias("_last")).filter("_last")
    ends = _same_exchange(ends, base) if shared else ends
    carry = ends.select(_KEY, _SEG, F.lag(value).over(_carry_window()).alias("_prev_seg"))
    rows = rows.select(*base, F.lag(value).over(w).alias("_prev_in"),
                       F.lag(F.lit(1)).over(w).isNull().alias("_first"))
    prev = F.when(F.col("_first"), F.col("_prev_seg")).otherwise(F.col("_prev_in"))
    return _finished(_patch(rows, carry), keys, base, prev.alias(out), keep_segment)


def segmented_running_max(df: DataFrame, key, order, value: str, segment: Column | None,
                          out: str, keep_segment: bool = False, shared: bool = True) -> DataFrame:
    """Add ``out`` = max of ``value`` over all rows of ``key`` up to this one."""
    keys, order_cols = _keys(key), _order(order)
    rows, w = _seg_rows(df, keys, order_cols, segment)
    frame = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    base = rows.columns
    windowed = rows.select(*base, F.max(value).over(frame).alias("_run_in"),
                           F.lead(F.lit(1)).over(w).isNull().alias("_last"))
    # the running maximum of a segment's last row is the segment's; then a prefix maximum
    ends = windowed.filter("_last")
    ends = _same_exchange(ends, base) if shared else ends
    carry = ends.select(_KEY, _SEG, F.max("_run_in").over(_carry_window(-1)).alias("_prev_max"))
    rows = rows.select(*base, F.max(value).over(frame).alias("_run_in"))
    run = F.greatest("_run_in", "_prev_max")
    return _finished(_patch(rows, carry), keys, base, run.alias(out), keep_segment)


# Tie-breaks are any long: they take 64 bits below the primary value.
_TIE_RANGE, _TIE_LEAST = Decimal(2 ** 64), -(2 ** 63)
# Stands for a NULL primary value: below every time (in micro-seconds) that Spark has.
_PRIMARY_LEAST = -(2 ** 62)


def epoch_units(df: DataFrame, name: str) -> Column:
    """Order-preserving integral value of a time/number column (session-zone free)."""
    t = df.schema[name].dataType.typeName()
    c = F.col(name)
    if t == "timestamp_ntz":
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)
    if t == "timestamp":
        return F.unix_micros(c)
    if t == "date":
        return F.unix_date(c).cast("long")
    if t in ("long", "integer", "short", "byte"):
        return c.cast("long")
    raise TypeError(f"cannot build an ordering key from {name}: {t}")


def order_key(df: DataFrame, primary: str, tiebreak: Column | None = None) -> Column:
    """A fixed-width ``decimal(38,0)`` key: ``primary * 2^64`` plus the tie-break.

    The tie-break is any long; a NULL primary or tie-break sorts first and the key
    is never NULL.  Unlike a struct, a decimal key keeps ``max_by`` in a hash
    aggregate (no sort of the input).
    """
    def dec(x):
        return x.cast("decimal(38,0)")

    key = dec(F.coalesce(epoch_units(df, primary), F.lit(_PRIMARY_LEAST))) * F.lit(_TIE_RANGE)
    if tiebreak is not None:
        key = dec(key) + dec(F.coalesce(tiebreak.cast("long"), F.lit(_TIE_LEAST)))
    return dec(key)


def latest_by(df: DataFrame, keys: Sequence[str], order: str, cols: Sequence[str]) -> DataFrame:
    """Newest row per key as one aggregation.

    Unlike ``row_number() = 1`` over a window, this is partially aggregated
    before the shuffle, so a key with billions of rows costs one row per
    map task on the wire.  Every column is taken with ``max_by`` over the
    same key - the order column, tie-broken by a hash of the row - so all
    columns come from one row and the aggregate stays hash-based.
    """
    keys = list(keys)
    rest = [c for c in cols if c not in keys]
    tie = F.xxhash64(*[F.col(c) for c in rest])
    k = order_key(df, order, tie)
    return df.groupBy(*keys).agg(*[F.max_by(c, k).alias(c) for c in rest])
