"""Daily returns (core model) and the running maximum used by the drawdown."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.operators.sequential import SEGMENT_COLUMNS, segmented_lag, segmented_running_max

DAILY_COLUMNS = ["date", "symbol", "close", "prev_close", "daily_return",
                 "open", "high", "low", "volume"]
#: What the marts read of the core model.
RISK_INPUT = ["date", "symbol", "close", "daily_return"]
SUMMARY_INPUT = [*RISK_INPUT, "volume"]


def stg_prices(raw: DataFrame) -> DataFrame:
    """Staging view: the raw bar columns, passed through."""
    return raw.select("date", "symbol", "open", "high", "low", "close", "volume",
                      "ingested_at")


def daily_returns(bars: DataFrame, keep_segment: bool = False, columns: Sequence[str] = DAILY_COLUMNS) -> DataFrame:
    """``prev_close`` = previous bar's close per symbol by date; simple return
    ``round((close - prev) / nullif(prev, 0), 6)``.  First bar and a zero
    previous close give NULL.  The lag is segmented by year (see
    ``operators.sequential``), so one symbol's history never sits in one task.
    ``keep_segment`` keeps the segment columns so the marts' running max reuses
    the (symbol, segment) partitioning instead of shuffling the rows again.
    ``columns`` are those that the caller reads: no others cross the wire, and as both
    branches of the lag then use the same ones, they share one exchange and one scan.
    ``bars`` stored in buckets (``sources.bucketed``) bring their segment columns and aren't shuffled.
    """
    bucketed = all(c in bars.columns for c in SEGMENT_COLUMNS)
    needed = [c for c in bars.columns if c in {"date", "symbol", "close", *columns, *SEGMENT_COLUMNS}]
    prev = segmented_lag(bars.select(*needed), "symbol", "date", "close", None if bucketed else F.year("date"),
                         "prev_close", keep_segment=keep_segment, shared=not bucketed)
    ret = F.round(F.try_divide(F.col("close") - F.col("prev_close"),
                               F.nullif(F.col("prev_close"), F.lit(0.0))), 6)
    extra = list(SEGMENT_COLUMNS) if keep_segment else []
    cols = [ret.alias("daily_return") if c == "daily_return" else c for c in columns]
    return prev.select(*cols, *extra)


def valid_returns(daily: DataFrame) -> DataFrame:
    """Rows every mart starts from: bars that have a return."""
    return daily.filter(F.col("daily_return").isNotNull())


def running_max(daily: DataFrame, shared: bool = True) -> DataFrame:
    """Running maximum of close per symbol by date over the rows with a
    return (the first bar is excluded, as in the marts).  Keeps the return
    so the risk mart aggregates these rows directly."""
    has_seg = all(c in daily.columns for c in SEGMENT_COLUMNS)
    if has_seg:   # already segmented and partitioned: keep it that way
        rets = valid_returns(daily).select("date", "close", "daily_return", *SEGMENT_COLUMNS)
        return segmented_running_max(rets, "symbol", "date", "close", None, "rolling_max",
                                     keep_segment=True, shared=shared)
    rets = valid_returns(daily).select("symbol", "date", "close", "daily_return")
    return segmented_running_max(rets, "symbol", "date", "close", F.year("date"), "rolling_max")
