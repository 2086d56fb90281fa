"""Daily bar sources and sinks: landing files, raw table, reruns, materialised models.

Layout of the landing area: Parquet under ``<root>/dt=<run date>/``, one
folder per run date; the bar date is epoch nanoseconds (BIGINT) and the
ingest time an ISO-8601 string, as the ingest step writes them.  Loading
reads every ``*.parquet`` below the root with an explicit schema and casts
to the raw table's types.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType

from marketlens.functions.scalar import nanos_to_date
from marketlens.operators.sequential import latest_by
from marketlens.schemas import LANDING_BARS, RAW_BARS

RAW_COLUMNS = [f.name for f in RAW_BARS.fields]
BAR_FIELDS = ["date", "open", "high", "low", "close", "volume"]
# ISO-8601 without offset, microseconds (ingest time text).
ISO_LOCAL = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
NANOS_PER_DAY = 86_400_000_000_000


def date_to_nanos(c) -> Column:
    """DATE -> epoch nanoseconds of its midnight (UTC), as BIGINT."""
    c = F.col(c) if isinstance(c, str) else c
    return F.unix_date(c).cast("long") * F.lit(NANOS_PER_DAY)


def to_landing(raw: DataFrame, *extra: str) -> DataFrame:
    """Raw bars in the landing file encoding (nanosecond date, text ingest time)."""
    return raw.select(
        date_to_nanos("date").alias("date"), "open", "high", "low", "close", "volume", "symbol",
        F.date_format("ingested_at", ISO_LOCAL).alias("ingested_at"), *extra)


def write_landing(raw: DataFrame, root: str, run_date: Column | str) -> str:
    """Write landing files partitioned by run date (``dt=YYYY-MM-DD``).

    Dynamic partition overwrite: re-running a date replaces only that
    date's folder.  Rows are rebalanced by date first: a date is a few files,
    and a date that is large is split.
    """
    day = F.col(run_date) if isinstance(run_date, str) else run_date
    staged = raw.withColumn("dt", F.date_format(day, "yyyy-MM-dd"))
    (to_landing(staged, "dt").hint("rebalance", "dt")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("dt").parquet(root))
    return root


def read_landing(spark: SparkSession, root: str, start: str | None = None, end: str | None = None,
                 run_dates: tuple[str, str] | None = None) -> DataFrame:
    """Landing rows with their run date ``dt``, under a given schema.

    ``start`` / ``end`` (end excluded) bound the bar date on the stored
    nanoseconds, so they reach the scan; ``run_dates`` (both included) prunes folders.
    """
    schema = StructType([*LANDING_BARS.fields]).add("dt", DateType())
    land = spark.read.schema(schema).option("pathGlobFilter", "*.parquet").parquet(root)
    if run_dates is not None:
        land = land.filter(F.col("dt").between(F.lit(run_dates[0]).cast("date"), F.lit(run_dates[1]).cast("date")))
    for bound, is_start in ((start, True), (end, False)):
        if bound is not None:
            nanos = (dt.date.fromisoformat(bound) - dt.date(1970, 1, 1)).days * NANOS_PER_DAY
            land = land.filter(F.col("date") >= nanos if is_start else F.col("date") < nanos)
    return land


def load_raw(spark: SparkSession, root: str, start: str | None = None, end: str | None = None,
             run_dates: tuple[str, str] | None = None) -> DataFrame:
    """All ``*.parquet`` files under the landing root -> typed raw bars (bounds as in ``read_landing``).

    The schema is given (no inference pass over the files); casts are ANSI,
    so a malformed value fails the load instead of becoming NULL.
    """
    return load_raw_columns(read_landing(spark, root, start, end, run_dates)).select(*RAW_COLUMNS)


def load_audit(raw: DataFrame) -> DataFrame:
    """Row count, first/last date and distinct symbols (one partial aggregation)."""
    return raw.agg(F.count(F.lit(1)).alias("n_rows"), F.min("date").alias("min_date"),
                   F.max("date").alias("max_date"),
                   F.count_distinct("symbol").alias("n_symbols"))


class NoDataError(ValueError):
    """Raised when an ingest run produced no bar for any symbol."""


def _require_rows(df: DataFrame) -> DataFrame:
    if df.isEmpty():                 # one cheap action: stops at the first row
        raise NoDataError("no data fetched for any symbol")
    return df


def normalise_frames(frames: Mapping[str, DataFrame], ingested_at: Column | None = None,
                     require_data: bool = True) -> DataFrame:
    """Per-symbol frames (any column case) -> one bar frame with symbol and ingest time.

    Column names are lower-cased, ``symbol`` and ``ingested_at`` added and
    the frames unioned by name.  Frames without rows add nothing; no row for
    any symbol is an error (``NoDataError``) unless ``require_data`` is off.
    """
    if not frames:
        raise NoDataError("no data fetched for any symbol")
    ts = ingested_at if ingested_at is not None else F.current_timestamp().cast("timestamp_ntz")
    parts = []
    for sym, df in frames.items():
        lowered = df.toDF(*[c.lower() for c in df.columns])
        parts.append(lowered.select(*BAR_FIELDS, F.lit(sym).alias("symbol"), ts.alias("ingested_at")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = out.select(*RAW_COLUMNS)
    return _require_rows(out) if require_data else out


def lookback_slice(raw: DataFrame, run_date: str, days: int = 365) -> DataFrame:
    """Bars in ``[run_date - days, run_date)``; a plain date range, so it
    reaches the Parquet scan as pushed filters."""
    end = F.to_date(F.lit(run_date))
    start = F.date_sub(end, days)
    cond = (F.col("date") >= start) & (F.col("date") < end)
    if "year" in raw.columns:   # a table laid out by year: prune its folders too
        cond = cond & (F.col("year") >= F.year(start)) & (F.col("year") <= F.year(end))
    return raw.filter(cond)


def universe_table(spark: SparkSession, symbols: Sequence[str]) -> DataFrame:
    """The configured symbols as data: ``symbol`` and its position ``ord`` (the pair and page order)."""
    return spark.createDataFrame([(s, i) for i, s in enumerate(symbols)], "symbol string, ord int")


def universe_filter(df: DataFrame, symbols: Sequence[str]) -> DataFrame:
    """Keep configured symbols only: an IN-list on the scan (pushed down),
    no join and no shuffle, whatever the data size."""
    return df.filter(F.col("symbol").isin(list(symbols)))


def dedup_latest(raw: DataFrame) -> DataFrame:
    """One bar per (symbol, date): the most recently ingested one.

    An aggregation (``max_by`` over ``ingested_at``), so duplicates are
    collapsed map-side before the shuffle.
    """
    return latest_by(raw, ["symbol", "date"], "ingested_at", RAW_COLUMNS).select(*RAW_COLUMNS)


def rerun_overwrite(spark: SparkSession, root: str, rows: DataFrame, run_date: str) -> int:
    """Replace the landing partition of ``run_date`` with ``rows``; return the
    number of rows the rerun removed (read with partition pruning)."""
    try:
        removed = read_landing(spark, root, run_dates=(run_date, run_date)).count()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":   # only a first run has nothing to delete
            raise
        removed = 0
    write_landing(rows, root, F.lit(run_date))
    return removed


def materialise(df: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    """Write a model as a full-refresh table and read it back (cuts lineage).

    ``partition_by`` lays the table out in folders (e.g. by year) so later
    date-range reads prune whole partitions.
    """
    if partition_by:
        df.hint("rebalance", partition_by).write.mode("overwrite").partitionBy(partition_by).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    return back.select(*df.columns) if partition_by else back


def stage_view(df: DataFrame, name: str) -> DataFrame:
    """Staging models are views, not tables."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def read_partitioned(spark: SparkSession, root: str) -> DataFrame:
    """Landing files with partition discovery: raw bars plus the run date ``dt``."""
    typed = load_raw_columns(read_landing(spark, root))
    return typed.withColumn("dt", F.col("_dt").cast("date")).drop("_dt")


def load_raw_columns(land: DataFrame, *extra: str) -> DataFrame:
    """Landing rows in the raw table's types; the run date as ``_dt`` where there is one, and ``extra`` columns."""
    cols = [nanos_to_date("date").alias("date"),
            F.col("open").cast("double"), F.col("high").cast("double"),
            F.col("low").cast("double"), F.col("close").cast("double"),
            F.col("volume").cast("long"), F.col("symbol").cast("string"),
            F.col("ingested_at").cast("timestamp_ntz").alias("ingested_at")]
    if "dt" in land.columns:
        cols.append(F.col("dt").alias("_dt"))
    return land.select(*cols, *extra)


def write_symbol_files(frames_by_symbol: DataFrame, root: str, fmt: str = "csv") -> str:
    """Land per-symbol bar files the way a market-data fetch delivers them
    (``symbol=<s>/`` folders, capitalised headers such as ``Date,Open``)."""
    (frames_by_symbol.hint("rebalance", "symbol").write.mode("overwrite").partitionBy("symbol")
     .option("header", "true").format(fmt).save(root))
    return root


def ingest_directory(spark: SparkSession, root: str, fmt: str = "csv",
                     ingested_at: Column | None = None, require_data: bool = True) -> DataFrame:
    """All per-symbol files under ``root`` in one scan -> raw bars.

    The scalable form of ``normalise_frames``: one plan whatever the number of
    symbols; column names are lower-cased and the symbol comes from the
    ``symbol=`` folder (partition discovery, typed as text).
    """
    land = (spark.read.format(fmt).option("header", "true").option("inferSchema", "false")
            .load(root))
    lowered = land.toDF(*[c.lower() for c in land.columns])
    ts = ingested_at if ingested_at is not None else F.current_timestamp().cast("timestamp_ntz")
    out = lowered.select(
        F.col("date").cast("date").alias("date"),
        *[F.col(c).cast("double").alias(c) for c in ("open", "high", "low", "close")],
        F.col("volume").cast("long").alias("volume"),
        F.col("symbol").cast("string").alias("symbol"),
        ts.alias("ingested_at"))
    return _require_rows(out) if require_data else out
