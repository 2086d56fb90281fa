"""Pairwise return correlation over a configured symbol universe.

Plan (no pair is ever emitted per date, nothing passes through the driver):

1. return rows (date, symbol index, return); duplicate bars of a (date, symbol)
   collapse by MAX (map-side) unless the bars are known to be one per day.
2. symbols form blocks of ``BLOCK``; rows are dealt by (pair of blocks, date) to
   a stated number of tasks, which AQE leaves alone: work grows with dates x
   pairs, not with bytes.  A task folds its dates' vectors into sums of one pair
   of blocks with numpy (Arrow batches) and passes on the moments of the pairs it
   has seen, so its state is BLOCK x BLOCK whatever the universe.  Sums are about
   the first value that the task saw of a symbol: they keep their precision for
   series with a large mean, and no pass over the data is needed for means.
3. moments (number, means, centred squares and product, extremes) of disjoint sets
   of dates merge by Chan's formulas, those of the tasks of one run as those of stored
   periods (``merged``), and Pearson's r follows.  Minima and maxima give an exact test
   for constant series.  Configured pairs without two common dates are NULL (a
   bare ``corr`` raises under ANSI): the pair table is joined last.

A single wide aggregation with 3-8 aggregates per pair was tried first: its
generated code grows with N^2 and cost seconds per query already at N = 8.
The ``returns_pivot`` report keeps the wide conditional-MAX form, since its
output is the date x symbol table itself.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.operators.returns import valid_returns
from marketlens.sources.universe import positions

#: Configured symbols: their names in order, or a table (symbol, ord), which leaves the plan as short as it is.
Universe = Sequence[str] | DataFrame


def _col(i: int) -> str:
    return f"_r{i}"


def pairs(universe: Sequence[str]) -> list[tuple[int, int]]:
    n = len(universe)
    return [(i, j) for i in range(n) for j in range(i + 1, n)]


def _pivot_positional(daily: DataFrame, universe: Sequence[str]) -> DataFrame:
    rets = valid_returns(daily).select("date", "symbol", "daily_return")
    aggs = [F.max(F.when(F.col("symbol") == F.lit(s), F.col("daily_return"))).alias(_col(i))
            for i, s in enumerate(universe)]
    return rets.groupBy("date").agg(*aggs)


def returns_pivot(daily: DataFrame, universe: Sequence[str]) -> DataFrame:
    """Date x symbol matrix of daily returns (column names = symbols)."""
    wide = _pivot_positional(daily, universe)
    return wide.select("date", *[F.col(_col(i)).alias(s) for i, s in enumerate(universe)])


#: Symbols in a block, and dates folded at once.
BLOCK, DATES = 64, 128
_SUMS = ("n", "sx", "sy", "sxx", "syy", "sxy")
#: Mergeable state of a pair: common dates, means, centred squares and product, extremes of both series.
MOMENTS = ("n", "mean_x", "mean_y", "m_xx", "m_yy", "m_xy", "min_x", "max_x", "min_y", "max_y")
_PARTIALS = "period int, i int, j int, " + ", ".join(f"{c} double" for c in MOMENTS)


class _BlockSums:
    """Sums over dates of one pair of blocks; entry [i, j] covers dates where both symbols have a value."""

    def __init__(self, period: int, bi: int, bj: int):
        self.key = period, bi, bj
        self.sums = np.zeros((len(_SUMS), BLOCK, BLOCK))
        self.shift = np.full((2, BLOCK), np.nan)
        self.least = np.full((2, BLOCK, BLOCK), np.inf)
        self.most = np.full((2, BLOCK, BLOCK), -np.inf)

    def add(self, dates: np.ndarray, ks: np.ndarray, xs: np.ndarray) -> None:
        day = np.cumsum(np.r_[0, dates[1:] != dates[:-1]])
        sides = []
        for side, b in enumerate(self.key[1:]):
            own = ks // BLOCK == b
            v = np.full((day[-1] + 1, BLOCK), np.nan)
            v[day[own], ks[own] % BLOCK] = xs[own]
            sides.append(v)
            first = np.take_along_axis(v, np.argmax(~np.isnan(v), axis=0)[None], 0)[0]
            self.shift[side] = np.where(np.isnan(self.shift[side]), first, self.shift[side])
        for start in range(0, day[-1] + 1, DATES):
            x, y = (v[start:start + DATES] for v in sides)
            mx, my = ~np.isnan(x), ~np.isnan(y)
            x0, y0 = np.where(mx, x - self.shift[0], 0.0), np.where(my, y - self.shift[1], 0.0)
            fx, fy = mx.astype(float), my.astype(float)
            self.sums += np.stack([fx.T @ fy, x0.T @ fy, fx.T @ y0, (x0 * x0).T @ fy, fx.T @ (y0 * y0), x0.T @ y0])
            both = mx[:, :, None] & my[:, None, :]
            for k, v in enumerate((x[:, :, None], y[:, None, :])):
                self.least[k] = np.minimum(self.least[k], np.where(both, v, np.inf).min(axis=0))
                self.most[k] = np.maximum(self.most[k], np.where(both, v, -np.inf).max(axis=0))

    def rows(self) -> pa.RecordBatch:
        i, j = np.nonzero(self.sums[0] > 0)
        period, bi, bj = self.key
        ii, jj = bi * BLOCK + i, bj * BLOCK + j
        keep = ii < jj
        i, j, ii, jj = i[keep], j[keep], ii[keep], jj[keep]
        n, sx, sy, sxx, syy, sxy = self.sums[:, i, j]
        cols = [n, self.shift[0, i] + sx / n, self.shift[1, j] + sy / n, sxx - sx * sx / n, syy - sy * sy / n, sxy - sx * sy / n,
                self.least[0, i, j], self.most[0, i, j], self.least[1, i, j], self.most[1, i, j]]
        ids = [pa.array(v, pa.int32()) for v in (np.full(len(ii), period), ii, jj)]
        return pa.RecordBatch.from_arrays([*ids, *map(pa.array, cols)],
                                          names=[c.split()[0] for c in _PARTIALS.split(", ")])


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (period, bi, bj, date, k, r) sorted by the first four -> moments; a date may go on in the next batch."""
    state, held = None, None

    def folded(cols):
        nonlocal state
        key = tuple(int(c[0]) for c in cols[:3])
        if state is None or state.key != key:
            if state is not None:
                yield state.rows()
            state = _BlockSums(*key)
        state.add(*cols[3:])

    for batch in batches:
        cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in range(6)]
        if held is not None:
            cols = [np.concatenate(c) for c in zip(held, cols)]
        if not len(cols[0]):
            continue
        new_pair = np.any([c[1:] != c[:-1] for c in cols[:3]], axis=0)
        new_date = np.flatnonzero(new_pair | (cols[3][1:] != cols[3][:-1])) + 1
        last = new_date[-1] if len(new_date) else 0
        held = [c[last:] for c in cols]
        starts = [0, *(x for x in np.flatnonzero(new_pair) + 1 if x < last), last]
        for a, b in zip(starts, starts[1:]):
            if a < b:
                yield from folded([c[a:b] for c in cols])
    if held is not None:
        yield from folded(held)
        yield state.rows()


def _returns(daily: DataFrame, universe: Universe) -> tuple[DataFrame, int]:
    """(date, k, r): the configured symbols' returns by their position; and how many symbols there are."""
    # one test of symbol and return: a test of the symbol alone would go below the lag's window, into one
    # of its two branches, which then no longer share their exchange
    valid = F.col("daily_return").isNotNull()
    if isinstance(universe, DataFrame):
        index = positions(universe)
        rets = daily.select("date", F.when(valid, F.col("symbol")).alias("symbol"), F.col("daily_return").alias("r"))
        return rets.join(index, "symbol").select("date", "k", "r"), index.count()
    index = F.create_map(*[x for i, u in enumerate(universe) for x in (F.lit(u), F.lit(i))])
    known = F.when(valid, index[F.col("symbol")])
    rets = daily.select("date", known.alias("k"), F.col("daily_return").alias("r")).filter(F.col("k").isNotNull())
    return rets, len(universe)


def pair_moments(daily: DataFrame, universe: Universe, unique_bars: bool = False,
                 period: Column | None = None) -> DataFrame:
    """(i, j, moments) per pair of symbols with a common date, or per ``period`` (an integer of the date) and pair.

    With ``unique_bars`` the caller guarantees one bar per symbol and date (e.g.
    after ``dedup_latest``), and the rows are shuffled once.
    """
    spark = daily.sparkSession
    rets, symbols = _returns(daily, universe)
    blocks = max(1, -(-symbols // BLOCK))
    if not unique_bars:
        rets = rets.groupBy("date", "k").agg(F.max("r").alias("r"))
    own = F.floor(F.col("k") / BLOCK).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    part = F.lit(0) if period is None else period.cast("int")
    rows = (rets.select(part.alias("period"), own.alias("own"), other.alias("other"), F.unix_date("date").alias("date"), "k", "r")
            .select("period", F.least("own", "other").alias("bi"), F.greatest("own", "other").alias("bj"), "date", "k", "r"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(tasks, "bi", "bj", "date").sortWithinPartitions("period", "bi", "bj", "date")
    parts = dealt.mapInArrow(_folded, _PARTIALS)
    return merged(parts) if period is None else merged(parts, ("period", "i", "j"))


def merged(parts: DataFrame, keys: Sequence[str] = ("i", "j")) -> DataFrame:
    """Moments of disjoint sets of dates added up per pair (Chan's formulas; one shuffle by pair)."""
    pair = Window.partitionBy(*keys)
    n = F.col("n")
    total = F.sum("n").over(pair)
    about = parts.withColumns({f"all_{v}": F.sum(n * F.col(f"mean_{v}")).over(pair) / total for v in "xy"})
    d = {v: F.col(f"mean_{v}") - F.col(f"all_{v}") for v in "xy"}
    return about.groupBy(*keys).agg(
        F.sum("n").alias("n"), *[F.first(f"all_{v}").alias(f"mean_{v}") for v in "xy"],
        *[F.sum(F.col(f"m_{a}{b}") + n * d[a] * d[b]).alias(f"m_{a}{b}") for a, b in ("xx", "yy", "xy")],
        *[f(f"{name}_{v}").alias(f"{name}_{v}") for v in "xy" for name, f in (("min", F.min), ("max", F.max))])


def _pearson() -> Column:
    """r from the moments; NULL for fewer than two common dates or a constant
    series on them (min = max, exact)."""
    ok = ((F.col("n") >= 2) & (F.col("min_x") != F.col("max_x")) & (F.col("min_y") != F.col("max_y"))
          & (F.col("m_xx") > 0) & (F.col("m_yy") > 0))
    r = F.col("m_xy") / F.sqrt(F.col("m_xx") * F.col("m_yy"))
    return F.round(F.when(ok, F.least(F.lit(1.0), F.greatest(F.lit(-1.0), r))), 4)


def correlation(daily: DataFrame, universe: Universe, unique_bars: bool = False) -> DataFrame:
    """Correlation mart: ``symbol_1, symbol_2, correlation`` per unordered pair.

    Every configured pair is present (NULL without two common dates)."""
    return correlation_of(pair_moments(daily, universe, unique_bars), universe)


def pair_dimension(universe: DataFrame) -> DataFrame:
    """(i, j, symbol_1, symbol_2): every pair of a universe table once, in its order."""
    index = positions(universe)
    most = F.max("k").over(Window.orderBy("k").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    first = (index.withColumn("most", most).filter("k < most")
             .select(F.col("k").alias("i"), F.col("symbol").alias("symbol_1"),
                     F.explode(F.sequence(F.col("k") + 1, F.col("most"))).alias("j")))
    return first.join(index.select(F.col("k").alias("j"), F.col("symbol").alias("symbol_2")), "j")


def correlation_of(moments: DataFrame, universe: Universe) -> DataFrame:
    """The mart from the pairs' moments."""
    if isinstance(universe, DataFrame):
        return pair_dimension(universe).join(moments, ["i", "j"], "left").select(
            "symbol_1", "symbol_2", _pearson().alias("correlation"))
    names = F.array(*[F.lit(u) for u in universe])
    n = len(universe)
    every = (moments.sparkSession.range(max(0, n - 1)).select(F.col("id").cast("int").alias("i"))
             .select("i", F.explode(F.sequence(F.col("i") + 1, F.lit(n - 1))).alias("j")))
    return every.join(moments, ["i", "j"], "left").select(
        F.element_at(names, F.col("i") + 1).alias("symbol_1"),
        F.element_at(names, F.col("j") + 1).alias("symbol_2"),
        _pearson().alias("correlation"))


def correlation_ranked(mart: DataFrame) -> DataFrame:
    return mart.orderBy(F.col("correlation").desc_nulls_last(), "symbol_1", "symbol_2")


def correlation_matrix(mart: DataFrame, universe: Sequence[str]) -> DataFrame:
    """Square matrix: symmetric completion of the pairs plus a unit diagonal.

    Works on the pair table (bounded by the universe, not by the data).
    """
    ordv = F.create_map(*[x for i, s in enumerate(universe) for x in (F.lit(s), F.lit(i))])
    pairs_df = mart.select("symbol_1", "symbol_2", "correlation")
    swapped = mart.select(F.col("symbol_2").alias("symbol_1"),
                          F.col("symbol_1").alias("symbol_2"), "correlation")
    cells = [F.max(F.when(F.col("symbol_2") == F.lit(s), F.col("correlation"))).alias(f"_m{i}")
             for i, s in enumerate(universe)]
    square = pairs_df.unionByName(swapped).groupBy(F.col("symbol_1").alias("symbol")).agg(*cells)
    return (square.select("symbol", *[F.when(F.col("symbol") == F.lit(s), F.lit(1.0))
                                       .otherwise(F.col(f"_m{i}")).alias(s)
                                       for i, s in enumerate(universe)])
            .orderBy(ordv[F.col("symbol")]))


def correlation_kpis(mart: DataFrame, universe: Sequence[str]) -> DataFrame:
    """Mean correlation, most and least correlated pair (first in pair order on ties)."""
    ordv = F.create_map(*[x for i, s in enumerate(universe) for x in (F.lit(s), F.lit(i))])
    c = F.col("correlation")
    o1, o2 = ordv[F.col("symbol_1")], ordv[F.col("symbol_2")]
    pair = F.struct("symbol_1", "symbol_2", "correlation")
    top = F.max_by(pair, F.when(c.isNotNull(), F.struct(c, -o1, -o2)))
    low = F.min_by(pair, F.when(c.isNotNull(), F.struct(c, o1, o2)))
    k = mart.agg(F.round(F.avg(c), 6).alias("avg_correlation"),
                 top.alias("_top"), low.alias("_low"))
    return k.select("avg_correlation",
                    F.col("_top.symbol_1").alias("most_symbol_1"),
                    F.col("_top.symbol_2").alias("most_symbol_2"),
                    F.col("_top.correlation").alias("most_correlation"),
                    F.col("_low.symbol_1").alias("least_symbol_1"),
                    F.col("_low.symbol_2").alias("least_symbol_2"),
                    F.col("_low.correlation").alias("least_correlation"))
