"""The batch run kept up to date: a run loads what is new and rewrites the states of the years it touched.

    landing files -> raw table (load once) -> states per year -> marts

``run_increment`` reads the new landing files, the raw rows of the touched years and, for
the marts, one state row per symbol (or pair) and year.  It never reads the history: a
run with one new date costs a year of bars.  Old dates that are loaded again change
their year alike, and the pairs of the next year, whose first returns start from it.

Every step can be repeated: the load skips files it knows, a year's states are replaced
as a whole, and a batch is noted as taken in only after its states are written, so a run
that failed half-way is made good by the next one.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marketlens.operators import states as st
from marketlens.session import scratch_dir
from marketlens.sources import incremental as inc
from marketlens.sources.bars import dedup_latest, materialise
from marketlens.sources.tables import read_or_empty

#: Folders of a run's tables.
RAW, RISK, PAIRS, TAKEN = "raw", "states/risk", "states/pairs", "states/taken_in"
TAKEN_SCHEMA = "batch_id long, universe array<string>"
#: What the states use of a bar.
USED = ["symbol", "date", "close", "volume"]


def _at(root: str, folder: str) -> str:
    return f"{root.rstrip('/')}/{folder}"


def _read(spark: SparkSession, root: str, folder: str, schema: str) -> DataFrame:
    return read_or_empty(spark, _at(root, folder), StructType.fromDDL(schema))


def read_risk_states(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, root, RISK, st.RISK_STATE)


def read_pair_states(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, root, PAIRS, st.PAIR_STATE)


def _years(rows: DataFrame) -> list[int]:
    """The distinct years of a layout column (as many as the history has)."""
    return sorted(r.year for r in rows.filter("year IS NOT NULL").select("year").distinct().collect())


def bars_of_years(spark: SparkSession, root: str, years: Sequence[int]) -> DataFrame:
    """The newest load of each bar of these years; no other folder is read."""
    rows = inc.read_raw_table(spark, _at(root, RAW)).filter(F.col("year").isin(list(years)))
    return dedup_latest(inc.raw_bars(rows))


def _replace(states: DataFrame, path: str) -> None:
    (states.hint("rebalance", "year").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("year").parquet(path))


def refresh_states(spark: SparkSession, root: str, universe: Sequence[str]) -> list[int]:
    """Rewrite the states of the years that batches not yet taken in have touched; these years."""
    raw = inc.read_raw_table(spark, _at(root, RAW))
    done = _read(spark, root, TAKEN, TAKEN_SCHEMA).agg(
        F.max("batch_id").alias("batch_id"), F.max_by("universe", "batch_id").alias("universe")).first()
    newest = raw.agg(F.max("batch_id").alias("batch_id")).first().batch_id
    if newest is None:
        return []
    since = -1 if done.batch_id is None else done.batch_id
    touched = _years(raw.filter(F.col("batch_id") > since))
    if touched:                                              # both kinds of states read the loads of a year once
        bars = materialise(bars_of_years(spark, root, touched).select(*USED), scratch_dir(spark, "touched_bars"))
        _replace(st.risk_states(bars), _at(root, RISK))
    states = read_risk_states(spark, root)
    if done.universe != list(universe):                      # other pairs: those of all years
        pair_years = _years(raw)
    else:
        after = st.carried(states).filter(F.col("prev_year").isin(touched))
        pair_years = sorted({*touched, *_years(after)})
    if pair_years:
        others = sorted({*pair_years} - {*touched})
        older = [bars_of_years(spark, root, others).select(*USED)] if others else []
        every = reduce(DataFrame.unionByName, [*([bars] if touched else []), *older])
        daily = st.returns_of_years(every, states)
        _replace(st.pair_states(daily, universe), _at(root, PAIRS))
    (spark.createDataFrame([(newest, list(universe))], TAKEN_SCHEMA).coalesce(1)
     .write.mode("append").parquet(_at(root, TAKEN)))
    return touched


def marts(spark: SparkSession, root: str, universe: Sequence[str]) -> dict[str, DataFrame]:
    """The marts, from states alone."""
    risk = read_risk_states(spark, root)
    return {"mart_risk_metrics": st.risk_mart(risk), "mart_portfolio_summary": st.summary_mart(risk),
            "mart_correlation": st.correlation_mart(read_pair_states(spark, root), universe)}


def run_increment(spark: SparkSession, landing: str, root: str, universe: Sequence[str]) -> dict[str, DataFrame]:
    """Load new landing files into ``root``, bring the states up to date, and return the marts."""
    inc.load_new_files(spark, landing, _at(root, RAW))
    refresh_states(spark, root, universe)
    return marts(spark, root, universe)
