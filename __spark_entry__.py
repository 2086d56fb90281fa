"""

Every query reads the driver's tables (``events``, ``orders``) through the
fixtures in ``marketlens.sources.fixtures`` and runs the library's operators
over the whole tables.  ``oracle_sql`` gives the same computation as DuckDB
SQL over the same parquet views; computed doubles are rounded identically
on both sides.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.functions.scalar import utc_wall_clock
from marketlens.operators import alerts as al
from marketlens.operators import correlation as corr
from marketlens.operators import quality as dq
from marketlens.operators import returns as rt
from marketlens.operators import risk
from marketlens.operators import sketches as sk
from marketlens.plans import incremental as pi
from marketlens.plans import pipeline as pl
from marketlens.plans import reports as rp
from marketlens.session import let_workers_import, scratch_dir
from marketlens.sources import bars as sb
from marketlens.sources import bucketed
from marketlens.sources import fixtures as fx
from marketlens.sources import incremental as inc
from marketlens.sources import semistructured as ss
from marketlens.sources import ticks as tk
from marketlens.sources import universe as un
from marketlens.streaming import alerts_stream as stx
from marketlens.streaming import tick_stream as tsx
from marketlens.streaming.compaction import compact, read_compacted, vacuum

SMOKE_DIR = "/root/testdata/sf0.001"

def _optional(name: str):
    """A module that may be absent, or may lack a library that it needs."""
    try:
        return import_module(name)
    except ImportError:
        return None


#: The corpus operators' queries, where that subpackage (and its pipeline module) can be imported.
EXTRA = [m for m in map(_optional, ("marketlens.llm.queries", "corpus_pipeline")) if m]


# ----------------------------------------------------------------------------
# Spark side
# ----------------------------------------------------------------------------

def _daily_or(spark, d, keep_segment=False, columns=rt.DAILY_COLUMNS):
    return rt.daily_returns(fx.orders_bars(spark, d), keep_segment, columns)


def _daily_ev(spark, d, keep_segment=False, columns=rt.DAILY_COLUMNS):
    return rt.daily_returns(fx.events_bars(spark, d), keep_segment, columns)


def q_mart_risk_metrics(spark, d):
    return risk.risk_metrics(_daily_or(spark, d, keep_segment=True, columns=rt.RISK_INPUT))


BUCKETS = 16


def _bucketed(df, name):
    """``df`` stored in buckets of (symbol, year), under a table name of its own."""
    path = scratch_dir(df.sparkSession, name)
    return bucketed.store_bucketed(df, path.rsplit("/", 1)[1].replace("-", "_"), path, BUCKETS)


def q_daily_returns_bucketed(spark, d):
    return rt.daily_returns(_bucketed(fx.orders_bars(spark, d), "bars_bucketed"))


def _core_bucketed(spark, d):
    bars = _bucketed(fx.orders_bars(spark, d), "bars_bucketed")
    return _bucketed(rt.daily_returns(bars, keep_segment=True, columns=rt.RISK_INPUT), "core_bucketed")


def q_running_max_bucketed(spark, d):
    return rt.running_max(_core_bucketed(spark, d), shared=False).select("symbol", "date", "close", "rolling_max")


def q_mart_risk_metrics_bucketed(spark, d):
    return risk.risk_metrics(_core_bucketed(spark, d), shared=False)


def q_mart_correlation(spark, d):
    # fixture bars are one per (symbol, date): a single shuffle by date suffices
    return corr.correlation(_daily_or(spark, d, columns=rt.RISK_INPUT), fx.ORDERS_UNIVERSE, unique_bars=True)


def _ticks(spark, d):
    return fx.events_ticks(spark, d)


def q_tick_parse(spark, d):
    text = tk.ticks_as_json(_ticks(spark, d))
    return (tk.parse_ticks(text)
            .select("symbol", "price", utc_wall_clock(F.col("event_time")).alias("event_time")))


def q_tick_stats(spark, d):
    st = al.tick_stats(_ticks(spark, d))
    return st.select("symbol", "n_ticks", F.round("volatility", 6).alias("volatility"),
                     F.round("avg_price", 6).alias("avg_price"), "max_price", "min_price",
                     "latest_price")


def q_batch_alerts(spark, d):
    return (al.alerts(_ticks(spark, d), ["symbol"])
            .select("symbol", "alert_type", F.round("metric_value", 6).alias("metric_value"),
                    "threshold_value", "price_at_alert"))


def q_alerts(spark, d):
    return al.window_alerts(_ticks(spark, d), "1 day")


# Filter choices used by the alerts page queries (a user's selection).
ALERT_SYMBOL_FILTER = ["click", "purchase", "view"]
ALERT_TYPE_FILTER = ["PRICE_DROP", "HIGH_VOLATILITY"]


def _recent(spark, d):
    return rp.recent_alerts(_stored(spark, d, q_alerts))


def _filtered(spark, d):
    return rp.alerts_filtered(_recent(spark, d), ALERT_SYMBOL_FILTER, ALERT_TYPE_FILTER)


#: Folders of marts stored by this application: the report pages read them.
STORED: dict[tuple[str, str, str], str] = {}


def _stored(spark, d, build):
    """What ``build`` computes, written once per application and read back."""
    key = (spark.sparkContext.applicationId, d, build.__name__)
    if key not in STORED:
        path = scratch_dir(spark, "stored_marts")
        sb.materialise(build(spark, d), path)
        STORED[key] = path
    return spark.read.parquet(STORED[key])


def _page(figures, build):
    """A report page over a stored mart."""
    return lambda spark, d: figures(_stored(spark, d, build))


def _summary_or(spark, d):
    return risk.portfolio_summary(_daily_or(spark, d, columns=rt.SUMMARY_INPUT), unique_bars=True)


def _summary_ev(spark, d):
    return risk.portfolio_summary(_daily_ev(spark, d, columns=rt.SUMMARY_INPUT), fx.events_bars(spark, d))


# Run parameters of the load-side queries.
RUN_DATE = "2000-01-01"                       # look-back slice end (exclusive)
RERUN_DT = "1998-01-01"                       # landing partition that is re-run
REFETCH_TS = "2024-06-28 18:00:00"            # ingest time of a re-run / normalised fetch
SWITCHED_OFF = ["C0", "C2", "C7"]
UNIVERSE_SUBSET = ["C1", "C3", "C5", "C9"]    # configured symbols (C9 has no data)


def _raw(spark, d):
    return fx.orders_raw(spark, d)


def _universe_or(spark, d, switched_off=()):
    """The bars' symbols as a stored universe, ordered by number."""
    number = F.substring("symbol", 2, 9).cast("int")
    found = fx.orders_bars(spark, d).select("symbol").distinct()
    on = found.select("symbol", F.when(F.col("symbol").isin(*switched_off), -1).otherwise(number).alias("ord"))
    return un.read_universe(spark, un.write_universe(on, scratch_dir(spark, "universe")))


def q_mart_correlation_universe(spark, d):
    return corr.correlation(_daily_or(spark, d, columns=rt.RISK_INPUT), _universe_or(spark, d), unique_bars=True)


def q_universe_pruned(spark, d):
    bars = fx.orders_bars(spark, d)
    table = un.read_by_symbol(spark, un.write_by_symbol(bars, scratch_dir(spark, "bars_by_symbol")), bars)
    return un.of_universe(table, _universe_or(spark, d, SWITCHED_OFF)).select("symbol", "date", "close", "volume")


def _month(col="date"):
    return F.trunc(F.col(col), "month")


def _landed(spark, d, name):
    root = scratch_dir(spark, name)
    sb.write_landing(_raw(spark, d), root, _month())
    return root


def q_raw_load(spark, d):
    return sb.load_raw(spark, _landed(spark, d, "landing"))


def q_nanos_to_date(spark, d):
    o = fx.table(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("_d"))
    nanos = sb.date_to_nanos("_d")
    return o.select("o_orderkey", nanos.alias("nanos"),
                    sb.nanos_to_date(nanos).alias("date"))


def q_ingest_normalise(spark, d):
    bars = fx.orders_bars(spark, d)
    frames = {s: bars.filter(F.col("symbol") == s)
              .select(*[F.col(c).alias(c.capitalize()) for c in sb.BAR_FIELDS])
              for s in fx.ORDERS_UNIVERSE}
    return sb.normalise_frames(frames, F.lit(REFETCH_TS).cast("timestamp_ntz"))


def q_ingest_directory(spark, d):
    bars = fx.orders_bars(spark, d)
    root = scratch_dir(spark, "symbol_files")
    sb.write_symbol_files(bars.select(*[F.col(c).alias(c.capitalize()) for c in sb.BAR_FIELDS],
                                      "symbol"), root)
    return sb.ingest_directory(spark, root, "csv", F.lit(REFETCH_TS).cast("timestamp_ntz"))


def q_lookback_slice(spark, d):
    table = sb.materialise(_raw(spark, d), scratch_dir(spark, "raw_table"))
    return sb.lookback_slice(table, RUN_DATE, 365)


def q_rerun_overwrite(spark, d):
    root = _landed(spark, d, "landing")
    redo = (_raw(spark, d).filter(_month() == F.lit(RERUN_DT).cast("date"))
            .withColumn("ingested_at", F.lit(REFETCH_TS).cast("timestamp_ntz")))
    sb.rerun_overwrite(spark, root, redo, RERUN_DT)
    return sb.load_raw(spark, root)


def q_partitioned_roundtrip(spark, d):
    return sb.read_partitioned(spark, _landed(spark, d, "landing"))


def _models(spark, d):
    return pl.build_models(_raw(spark, d), fx.ORDERS_UNIVERSE)


def q_materialise(spark, d):
    out = pl.run_batch(_raw(spark, d), fx.ORDERS_UNIVERSE, scratch_dir(spark, "models"), gate=False)
    return out["mart_risk_metrics"]


def q_dq_report(spark, d):
    """The pipeline's test step: models materialised once, then all tests read
    the stored tables (plus the raw bars and the alert table)."""
    out = pl.run_batch(_raw(spark, d), fx.ORDERS_UNIVERSE, scratch_dir(spark, "models"),
                       alerts=q_alerts(spark, d), gate=False)
    return out["quality_report"]


def q_dq_unique(spark, d):
    m = _models(spark, d)
    parts = [dq.unique_failures(m[t], "symbol").select(F.lit(t).alias("model"), "value", "n")
             for t in ("mart_risk_metrics", "mart_portfolio_summary")]
    return parts[0].unionByName(parts[1])


def _dirty_tables(spark, d):
    m = _models(spark, d)
    clean = {"raw_stock_prices": _raw(spark, d), "risk_alerts": q_alerts(spark, d),
             "int_stock_daily": m["int_stock_daily"], "mart_risk_metrics": m["mart_risk_metrics"],
             "mart_portfolio_summary": _summary_ev(spark, d), "mart_correlation": m["mart_correlation"]}
    return {k: fx.dirty(v, k) for k, v in clean.items()}


def q_dq_gate(spark, d):
    """The gate over dirty tables without the alert table, whose tests can't run."""
    tables = _dirty_tables(spark, d)
    del tables["risk_alerts"]
    return dq.gate_outcome(dq.quality_report(tables))


def _checked(spark, d):
    return {m: dq.write_checked(df, scratch_dir(spark, m), m) for m, df in _dirty_tables(spark, d).items()}


def q_dq_quarantine(spark, d):
    """The rows of the dirty raw bars and alerts that fail a test, from the folders that the checked writes left."""
    parts = [m.quarantine.select(F.lit(name).alias("model"), "symbol", F.array_join(dq.FAILED_TESTS, ",").alias("failed_tests"))
             for name, m in _checked(spark, d).items() if "symbol" in m.table.columns]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_var_95_sketched(spark, d):
    """VaR of tick returns from day sketches that two runs stored; its rank error by counting all returns."""
    returns, path = sk.tick_returns(_ticks(spark, d)), scratch_dir(spark, "day_sketches")
    early = F.col("day") < F.lit(CLOSED_BEFORE)
    for part in (returns.filter(early), returns.filter(~early)):
        sk.write_day_sketches(part, path)
    found = sk.var_95_of_sketches(sk.read_day_sketches(spark, path))
    small = found.select("symbol", "least", "most", (F.col("sketch_bytes") < 64 * sk.K).alias("bounded"))
    return sk.rank_error(found, returns).join(small, "symbol").select(
        "symbol", "n", "least", "most", "bounded", (F.col("rank_error") <= sk.RANK_ERROR).alias("within_error"))


def q_tick_parse_dirty(spark, d):
    """Messages without a symbol and lines that aren't JSON are dropped."""
    t = _ticks(spark, d)
    no_symbol = t.withColumn("symbol", F.when(F.col("symbol") != "click", F.col("symbol")))
    text = tk.ticks_as_json(no_symbol).union(t.select(F.concat(F.lit("not json "), "symbol").alias("value")))
    return (tk.parse_ticks(text).select("symbol", "price", "volume", utc_wall_clock(F.col("event_time")).alias("event_time")))


def q_dedup_null_ingest(spark, d):
    """Bars whose ingest time is NULL stay, unless a later load replaces them."""
    bars = fx.orders_bars(spark, d)
    unknown = bars.withColumn("ingested_at", F.lit(None).cast("timestamp_ntz"))
    again = (bars.filter(F.day("date") % 2 == 1).withColumn("close", F.col("close") + 1)
             .withColumn("ingested_at", F.lit(REFETCH_TS).cast("timestamp_ntz")))
    return sb.dedup_latest(unknown.unionByName(again).select(*sb.RAW_COLUMNS))


# Odd ticks' sequences lie this far apart, up to the last one that is a long.
ODD_STEP = 90_000_000_000_000
ODD_LAST = (2 ** 63 - 1) // ODD_STEP


def _odd_ticks(spark, d):
    """Ticks without a time, and sequences over the whole range of a long: those after the last
    one whose product is a long follow it one by one, so they stay distinct and in order."""
    t = _ticks(spark, d)
    near = F.greatest(F.lit(-ODD_LAST), F.least(F.lit(ODD_LAST), F.col("seq")))
    return (t.withColumn("event_time", F.when(F.col("seq") % 10 != 0, F.col("event_time")))
            .withColumn("seq", near * ODD_STEP + (F.col("seq") - near)))


def q_rerun_removed(spark, d):
    root = _landed(spark, d, "landing")
    redo = _raw(spark, d).filter(_month() == F.lit(RERUN_DT).cast("date"))
    removed = [sb.rerun_overwrite(spark, root, redo.limit(0), day) for day in (RERUN_DT, "2090-01-01")]
    return spark.createDataFrame([tuple(removed)], "removed long, removed_new_date long")


def q_load_pruned(spark, d):
    """Landing rows of a few run dates and a range of bar dates: folders and row groups are pruned."""
    return sb.load_raw(spark, _landed(spark, d, "landing"), "1995-02-10", "1995-06-20", ("1995-01-01", "1995-05-01"))


# The first incremental run covers run dates (months) before this one; later ones the rest.
SECOND_RUN = "1996-05-01"


def _in_two_runs(spark, d, run):
    """Land the earlier run dates, run, land the later ones, run again, and once more over nothing new."""
    land, root = scratch_dir(spark, "landing"), scratch_dir(spark, "kept_up")
    raw, later = _raw(spark, d), _month() >= F.lit(SECOND_RUN).cast("date")
    sb.write_landing(raw.filter(~later), land, _month())
    run(land, root)
    sb.write_landing(raw.filter(later), land, _month())
    run(land, root)
    return land, root, run(land, root)


def _loaded_twice(spark, d):
    return _in_two_runs(spark, d, lambda land, table: inc.load_new_files(spark, land, table) and None)[1]


def _drifted_lines(spark, d):
    """Landing records as JSON lines; of every 50 orders some are malformed, and some have drifted."""
    land = sb.to_landing(_raw(spark, d).withColumn("key", F.second("ingested_at") + 60 * F.minute("ingested_at")), "key")
    text = F.to_json(F.struct(*[c for c in land.columns if c != "key"]))
    nth = F.col("key") % 50
    edited = (F.when(nth == 0, F.substring(text, 1, 20)).when(nth == 1, F.lit("[1, 2]"))
              .when(nth == 2, F.regexp_replace(text, '"close":[^,]*', '"close":"n/a"'))
              .when(nth == 3, F.regexp_replace(text, '"volume":1', '"turnover":{"eur":1}'))
              .when(nth == 4, F.regexp_replace(text, '"close":([^,]*)', '"close":"$1"'))
              .when(nth == 5, F.regexp_replace(F.regexp_replace(text, '"date":[0-9-]*', '"date":"?"'), '"volume":1', '"volume":"one"'))
              .otherwise(text))
    path = scratch_dir(spark, "json_landing")
    land.select(edited.alias("value")).write.text(path)
    return ss.write_loaded(ss.read_lines(spark, path), scratch_dir(spark, "json_loaded"))


def q_json_rejected(spark, d):
    """How many lines were rejected for which reasons."""
    return (_drifted_lines(spark, d)[1].select(F.array_join("reasons", ", ").alias("reasons"), F.length("value").alias("n"))
            .groupBy("reasons").agg(F.count(F.lit(1)).alias("n_lines")))


def q_incremental_load(spark, d):
    return inc.raw_bars(inc.read_raw_table(spark, _loaded_twice(spark, d)))


def q_incremental_history(spark, d):
    """Each run date's rows, and the load that took them up: the second one opened the new files only."""
    history = inc.load_history(inc.read_raw_table(spark, _loaded_twice(spark, d)))
    return history.select("batch_id", "dt", "n_rows", "min_date", "max_date")


def _kept_up(spark, d, mart):
    return _in_two_runs(spark, d, lambda land, root: pi.run_increment(spark, land, root, fx.ORDERS_UNIVERSE))[2][mart]


def _corrected(spark, d, mart):
    """A run over everything, then old bars loaded anew with other prices: the border of two years changes."""
    land, root, _ = _in_two_runs(spark, d, lambda land, root: pi.run_increment(spark, land, root, fx.ORDERS_UNIVERSE))
    redo = (_raw(spark, d).filter(F.col("date").between(F.lit(CORRECTED[0]).cast("date"), F.lit(CORRECTED[1]).cast("date")))
            .withColumn("close", F.col("close") + 1).withColumn("ingested_at", F.lit(REFETCH_TS).cast("timestamp_ntz")
                        + F.make_dt_interval(secs=F.col("close").cast("decimal(18,6)"))))
    sb.write_landing(redo, land, F.lit("2024-06-28").cast("date"))
    return pi.run_increment(spark, land, root, fx.ORDERS_UNIVERSE)[mart]


# Bar dates that are loaded again with other closes (both included).
CORRECTED = ("1994-12-20", "1995-01-05")

# Event-time scope of the streaming alert queries.
STREAM_WINDOW = "1 day"


def _tick_files(spark, d):
    return tk.write_tick_files(_ticks(spark, d), scratch_dir(spark, "ticks_in"))


def q_tick_stream(spark, d):
    src = tk.read_tick_stream(spark, _tick_files(spark, d))
    sink, ck = scratch_dir(spark, "ticks_out"), scratch_dir(spark, "ticks_ck")
    q = (src.writeStream.format("parquet").option("path", sink)
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    stx.run_to_end(q)
    return (spark.read.parquet(sink)
            .select("symbol", "price", utc_wall_clock(F.col("event_time")).alias("event_time")))


def q_stream_alerts(spark, d):
    """Per-micro-batch alerts; with everything landed before the run, the
    available-now run is one batch, i.e. the whole table per symbol."""
    src = tk.read_tick_stream(spark, _tick_files(spark, d))
    sink, ck = scratch_dir(spark, "alerts_out"), scratch_dir(spark, "alerts_ck")
    stx.run_to_end(stx.start_micro_batch_alerts(src, sink, ck))
    return (stx.read_alerts(spark, sink)
            .select("symbol", "alert_type", F.round("metric_value", 6).alias("metric_value"),
                    "threshold_value", "price_at_alert"))


def q_stream_two_runs(spark, d):
    """Two runs, each with its own checkpoint and half of the ticks, append to one sink."""
    sink = scratch_dir(spark, "alerts_out")
    for half in (0, 1):
        files = tk.write_tick_files(_ticks(spark, d).filter(F.col("seq") % 2 == half), scratch_dir(spark, "ticks_in"))
        src, ck = tk.read_tick_stream(spark, files), scratch_dir(spark, "alerts_ck")
        stx.run_to_end(stx.start_micro_batch_alerts(src, sink, ck))
    return (stx.read_alerts(spark, sink)
            .select("symbol", "alert_type", F.round("metric_value", 6).alias("metric_value"),
                    "threshold_value", "price_at_alert"))


def _windowed_run(spark, d, runs=1, shuffled=False):
    ticks = _ticks(spark, d)
    if shuffled:   # five files, none in time order, one per batch
        ticks = ticks.repartitionByRange(5, F.xxhash64("seq"))
    src_path = tk.write_tick_files(ticks, scratch_dir(spark, "ticks_in"))
    sink, ck = scratch_dir(spark, "walerts_out"), scratch_dir(spark, "walerts_ck")
    for _ in range(runs):   # a rerun on the same checkpoint must add nothing
        src = tk.read_tick_stream(spark, src_path, 1 if shuffled else None)
        stx.run_to_end(stx.start_windowed_alerts(src, sink, ck, STREAM_WINDOW))
    return stx.read_windowed_alerts(spark, sink)


def q_tick_change_streamed(spark, d):
    """Ticks land in four pieces, in the order of their times; the stream restarts after each."""
    ticks = _ticks(spark, d)
    src, sink, ck = (scratch_dir(spark, n) for n in ("ticks_in", "changes_out", "changes_ck"))
    piece = F.pmod(F.floor(F.datediff("event_time", F.lit("2024-01-01")) / 8), F.lit(64))
    ticks = ticks.withColumn("piece", F.least(piece, F.lit(3)))
    for k in range(4):
        tk.ticks_as_json(ticks.filter(F.col("piece") == k)).write.mode("append").text(src)
        stx.run_to_end(tsx.start_changes(tk.read_tick_stream(spark, src), sink, ck))
    return (tsx.read_changes(spark, sink).drop("day", "run_id", "batch_id")
            .withColumn("event_time", utc_wall_clock(F.col("event_time"))))


def q_stream_compacted(spark, d):
    """Five unordered batches; half of the days are compacted, the batches behind them removed."""
    return stx.windowed_alerts(_compacted_sink(spark, d))


def _compacted_sink(spark, d):
    ticks = _ticks(spark, d).repartitionByRange(5, F.xxhash64("seq"))
    src = tk.write_tick_files(ticks, scratch_dir(spark, "ticks_in"))
    sink, ck = scratch_dir(spark, "walerts_out"), scratch_dir(spark, "walerts_ck")
    stx.run_to_end(stx.start_windowed_alerts(tk.read_tick_stream(spark, src, 1), sink, ck, STREAM_WINDOW))
    compact(spark, sink, stx.WINDOW_STATS, CLOSED_BEFORE, stx.fullest)
    vacuum(spark, sink, stx.WINDOW_STATS)
    return read_compacted(spark, sink, stx.WINDOW_STATS)


def q_recent_compacted(spark, d):
    """The newest alerts of a compacted sink, from its newest days."""
    rows = _compacted_sink(spark, d)
    return rp.newest_alerts(lambda days: stx.windowed_alerts(rp.by_day(rows)(days)), rp.days_of(rows), reach=dt.timedelta(days=1))


def q_recent_newest_days(spark, d):
    alerts = q_alerts(spark, d).withColumn("day", F.to_date("triggered_at"))
    stored = sb.materialise(alerts, scratch_dir(spark, "alerts_by_day"), partition_by="day")
    return rp.newest_alerts(rp.by_day(stored), rp.days_of(stored))


def q_stream_quiet(spark, d):
    """Each symbol's first tick alone: no alert, a sink without a file, and a page that says so."""
    first = _ticks(spark, d).groupBy("symbol").agg(F.min_by(F.struct("price", "event_time", "seq", "volume"), "event_time").alias("t"))
    src = tk.write_tick_files(first.select("symbol", "t.*"), scratch_dir(spark, "ticks_in"))
    sink, ck = scratch_dir(spark, "alerts_out"), scratch_dir(spark, "alerts_ck")
    stx.run_to_end(stx.start_micro_batch_alerts(tk.read_tick_stream(spark, src), sink, ck))
    return rp.alert_kpis(rp.recent_alerts(stx.read_alerts(spark, sink)))


# Days of the alert sink that are closed.
CLOSED_BEFORE = dt.date(2024, 1, 16)


def q_windowed_two_runs(spark, d):
    """Two windowed runs, each with its own checkpoint and half of the ticks of every window, into one sink."""
    sink = scratch_dir(spark, "walerts_out")
    for half in (0, 1):
        files = tk.write_tick_files(_ticks(spark, d).filter(F.col("seq") % 2 == half), scratch_dir(spark, "ticks_in"))
        src, ck = tk.read_tick_stream(spark, files), scratch_dir(spark, "walerts_ck")
        stx.run_to_end(stx.start_windowed_alerts(src, sink, ck, STREAM_WINDOW))
    return stx.read_windowed_alerts(spark, sink)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the per-symbol risk mart over daily bars derived from orders."""
    return q_mart_risk_metrics(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = {
        "daily_returns": _daily_or,
        "daily_returns_dense": _daily_ev,
        "running_max": lambda s, d: rt.running_max(_daily_or(s, d, columns=rt.RISK_INPUT))
        .select("symbol", "date", "close", "rolling_max"),
        "max_drawdown": lambda s, d: risk.max_drawdown(_daily_or(s, d, keep_segment=True, columns=rt.RISK_INPUT)),
        "var_95": lambda s, d: risk.var_95(_daily_or(s, d, columns=rt.RISK_INPUT)),
        "mart_risk_metrics": q_mart_risk_metrics,
        "mart_risk_metrics_dense": lambda s, d: risk.risk_metrics(_daily_ev(s, d, keep_segment=True, columns=rt.RISK_INPUT)),
        "daily_returns_bucketed": q_daily_returns_bucketed,
        "running_max_bucketed": q_running_max_bucketed,
        "mart_risk_metrics_bucketed": q_mart_risk_metrics_bucketed,
        "risk_ranking": _page(risk.risk_ranking, q_mart_risk_metrics),
        "latest_prices": lambda s, d: risk.latest_prices(_daily_or(s, d), fx.orders_bars(s, d)),
        "mart_portfolio_summary": lambda s, d: _summary_or(s, d),
        "mart_portfolio_summary_dense": lambda s, d: _summary_ev(s, d),
        "returns_pivot": lambda s, d: corr.returns_pivot(_daily_or(s, d, columns=rt.RISK_INPUT), fx.ORDERS_UNIVERSE),
        "mart_correlation": q_mart_correlation,
        "mart_correlation_dense": lambda s, d: corr.correlation(_daily_ev(s, d, columns=rt.RISK_INPUT), fx.EVENTS_UNIVERSE),
        "correlation_ranked": _page(corr.correlation_ranked, q_mart_correlation),
        "correlation_matrix": _page(lambda m: corr.correlation_matrix(m, fx.ORDERS_UNIVERSE), q_mart_correlation),
        "correlation_kpis": _page(lambda m: corr.correlation_kpis(m, fx.ORDERS_UNIVERSE), q_mart_correlation),
        "correlation_kpis_display": _page(lambda m: rp.correlation_kpis_display(
            corr.correlation_kpis(m, fx.ORDERS_UNIVERSE)), q_mart_correlation),
        "tick_parse": q_tick_parse,
        "tick_encode": lambda s, d: tk.encode_ticks(al.tick_change(_ticks(s, d))),
        "tick_change": lambda s, d: al.tick_change(_ticks(s, d)),
        "tick_latest": lambda s, d: al.tick_latest(_ticks(s, d)),
        "tick_stats": q_tick_stats,
        "batch_alerts": q_batch_alerts,
        "alerts": q_alerts,
        "recent_alerts": _recent,
        "alert_kpis": lambda s, d: rp.alert_kpis(_recent(s, d)),
        "alerts_filtered": _filtered,
        "alert_filter_values": lambda s, d: rp.alert_filter_values(_recent(s, d)),
        "alert_severity": lambda s, d: rp.alert_severity_view(_recent(s, d)),
        "alerts_by_symbol": lambda s, d: rp.alerts_by_symbol(_filtered(s, d)),
        "alerts_by_symbol_all": lambda s, d: rp.alerts_by_symbol(_recent(s, d)),
        "alerts_timeline": lambda s, d: rp.alerts_timeline(_filtered(s, d)),
        "risk_report": _page(rp.risk_report, q_mart_risk_metrics),
        "risk_kpis": _page(lambda m: rp.risk_kpis(rp.risk_figures(m)), q_mart_risk_metrics),
        "risk_kpis_display": _page(lambda m: rp.risk_kpis_display(rp.risk_kpis(rp.risk_figures(m))),
                                   q_mart_risk_metrics),
        "portfolio_overview": _page(rp.portfolio_overview, _summary_or),
        "portfolio_kpis": _page(lambda m: rp.portfolio_kpis(rp.portfolio_figures(m)), _summary_or),
        "portfolio_overview_dense": _page(rp.portfolio_overview, _summary_ev),
        "portfolio_display": _page(lambda m: rp.portfolio_display(rp.portfolio_overview(m)), _summary_ev),
        "portfolio_kpis_display": _page(lambda m: rp.portfolio_kpis_display(
            rp.portfolio_kpis(rp.portfolio_figures(m))), _summary_ev),
        "alert_kpis_display": lambda s, d: rp.alert_kpis_display(rp.alert_kpis(_recent(s, d))),
        "stg_prices": lambda s, d: rt.stg_prices(_raw(s, d)),
        "raw_load": q_raw_load,
        "load_audit": lambda s, d: sb.load_audit(q_raw_load(s, d)),
        "nanos_to_date": q_nanos_to_date,
        "ingest_normalise": q_ingest_normalise,
        "ingest_directory": q_ingest_directory,
        "ingest_preview": lambda s, d: rp.preview(
            q_ingest_normalise(s, d),
            [F.array_position(F.array(*[F.lit(u) for u in fx.ORDERS_UNIVERSE]), F.col("symbol")),
             "date"]),
        "lookback_slice": q_lookback_slice,
        "universe_filter": lambda s, d: sb.universe_filter(_raw(s, d), UNIVERSE_SUBSET),
        "dedup_latest": lambda s, d: sb.dedup_latest(_raw(s, d)),
        "rerun_overwrite": q_rerun_overwrite,
        "partitioned_roundtrip": q_partitioned_roundtrip,
        "int_stock_daily": lambda s, d: _models(s, d)["int_stock_daily"],
        "materialise": q_materialise,
        "dq_report": q_dq_report,
        "dq_unique": q_dq_unique,
        "dq_accepted_values": lambda s, d: dq.accepted_values_failures(
            q_alerts(s, d), "alert_type", dq.ALERT_TYPE_VALUES).select("alert_id", "alert_type"),
        "dq_correlation_range": lambda s, d: dq.correlation_out_of_range(
            _models(s, d)["mart_correlation"]),
        "dq_report_dirty": lambda s, d: dq.quality_report(_dirty_tables(s, d)),
        "dq_gate": q_dq_gate,
        "dq_unique_dirty": lambda s, d: dq.unique_failures(_dirty_tables(s, d)["mart_risk_metrics"], "symbol"),
        "dq_accepted_values_dirty": lambda s, d: dq.accepted_values_failures(
            _dirty_tables(s, d)["risk_alerts"], "alert_type", dq.ALERT_TYPE_VALUES).select("alert_id", "alert_type"),
        "dq_correlation_range_dirty": lambda s, d: dq.correlation_out_of_range(
            _dirty_tables(s, d)["mart_correlation"]),
        "dq_report_written": lambda s, d: dq.checked_report(_checked(s, d)),
        "dq_quarantine": q_dq_quarantine,
        "var_95_sketched": q_var_95_sketched,
        "tick_parse_dirty": q_tick_parse_dirty,
        "tick_change_odd": lambda s, d: al.tick_change(_odd_ticks(s, d)),
        "tick_latest_odd": lambda s, d: al.tick_latest(_odd_ticks(s, d)),
        "dedup_null_ingest": q_dedup_null_ingest,
        "rerun_removed": q_rerun_removed,
        "load_pruned": q_load_pruned,
        "pipeline_lookback": lambda s, d: pl.run_batch(
            _raw(s, d), fx.ORDERS_UNIVERSE, scratch_dir(s, "models"), gate=False,
            run_date="1997-01-01")["int_stock_daily"],
        "universe_bars": lambda s, d: (fx.orders_bars(s, d).join(sb.universe_table(s, UNIVERSE_SUBSET), "symbol")
                                       .groupBy("symbol", "ord").agg(F.count(F.lit(1)).alias("n_bars"))),
        "universe_pruned": q_universe_pruned,
        "mart_correlation_universe": q_mart_correlation_universe,
        "pipeline_universe": lambda s, d: pl.run_batch(
            _raw(s, d), _universe_or(s, d, SWITCHED_OFF), scratch_dir(s, "models"), gate=False)["mart_correlation"],
        "json_load": lambda s, d: _drifted_lines(s, d)[0],
        "json_rejected": q_json_rejected,
        "incremental_load": q_incremental_load,
        "incremental_history": q_incremental_history,
        "incremental_risk": lambda s, d: _kept_up(s, d, "mart_risk_metrics"),
        "incremental_summary": lambda s, d: _kept_up(s, d, "mart_portfolio_summary"),
        "incremental_correlation": lambda s, d: _kept_up(s, d, "mart_correlation"),
        "incremental_risk_corrected": lambda s, d: _corrected(s, d, "mart_risk_metrics"),
        "incremental_correlation_corrected": lambda s, d: _corrected(s, d, "mart_correlation"),
        "tick_stream": q_tick_stream,
        "tick_change_streamed": q_tick_change_streamed,
        "stream_quiet": q_stream_quiet,
        "stream_compacted": q_stream_compacted,
        "recent_alerts_compacted": q_recent_compacted,
        "recent_alerts_newest_days": q_recent_newest_days,
        "stream_alerts": q_stream_alerts,
        "stream_alerts_windowed": lambda s, d: _windowed_run(s, d, 1),
        "stream_restart": lambda s, d: _windowed_run(s, d, 2),
        "stream_alerts_unordered": lambda s, d: _windowed_run(s, d, 1, shuffled=True),
        "stream_alerts_two_runs": q_stream_two_runs,
        "stream_windowed_two_runs": q_windowed_two_runs,
        "recent_alerts_streamed": lambda s, d: rp.recent_alerts(_windowed_run(s, d, 1)),
    }
    for module in EXTRA:
        own |= module.queries()
    return {name: _importable(query) for name, query in own.items()}


def _importable(query):
    """The query, after making the package importable for Python workers."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        let_workers_import(spark)
        return query(spark, sf_dir)

    return run


# ----------------------------------------------------------------------------
# DuckDB oracle
# ----------------------------------------------------------------------------

BARS_OR = """
SELECT CAST(o_orderdate AS DATE) AS date, 'C' || CAST(o_custkey % 8 AS VARCHAR) AS symbol,
       arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high,
       min(o_totalprice) AS low, arg_max(o_totalprice, o_orderkey) AS close,
       count(*) AS volume
FROM orders GROUP BY 1, 2"""

BARS_EV = """
SELECT CAST(ts AS DATE) AS date, 'U' || CAST(user_id % 8 AS VARCHAR) AS symbol,
       arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low,
       arg_max(value, (ts, event_id)) AS close, count(*) AS volume
FROM events GROUP BY 1, 2"""

DAILY = """
SELECT date, symbol, close, LAG(close) OVER w AS prev_close,
       ROUND((close - LAG(close) OVER w) / NULLIF(LAG(close) OVER w, 0), 6) AS daily_return,
       open, high, low, volume
FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY date)"""

RETS = "SELECT * FROM daily WHERE daily_return IS NOT NULL"

# The peak of a date: the largest close on any date up to it.
RUNMAX = """
SELECT r.symbol, r.date, any_value(r.close) AS close, any_value(r.daily_return) AS daily_return,
       max(e.close) AS rolling_max
FROM rets r JOIN rets e ON e.symbol = r.symbol AND e.date <= r.date
GROUP BY r.symbol, r.date"""

# From the definitions: sample variance about the mean, the 5% point between the two
# nearest ranks, the largest fall from a peak.
RISK = """
SELECT symbol, n AS trading_days, round(mean * 100, 4) AS avg_daily_return_pct,
       round(sd * 100, 4) AS daily_volatility_pct, round(sd * sqrt(252.0) * 100, 4) AS annual_volatility_pct,
       round(rs[1] * 100, 4) AS max_daily_loss_pct, round(rs[n] * 100, 4) AS max_daily_gain_pct,
       round((rs[lo + 1] + (rs[least(lo + 2, n)] - rs[lo + 1]) * (point - lo)) * 100, 4) AS var_95_pct,
       CASE WHEN sd <> 0 THEN round(mean / sd * sqrt(252.0), 4) END AS sharpe_ratio,
       round(fall * 100, 4) AS max_drawdown_pct
FROM (SELECT *, CAST(floor(point) AS BIGINT) AS lo,
             CASE WHEN n > 1 THEN sqrt(list_sum(list_transform(rs, lambda r: (r - mean) * (r - mean))) / (n - 1)) END AS sd
      FROM (SELECT symbol, count(*) AS n, sum(daily_return) / count(*) AS mean, list_sort(list(daily_return)) AS rs,
                   0.05 * (count(*) - 1) AS point,
                   max(CASE WHEN rolling_max <> 0 THEN 1 - close / rolling_max END) AS fall
            FROM runmax GROUP BY symbol))"""

LATEST = """
SELECT symbol, close AS latest_close, date AS latest_date FROM daily
QUALIFY dense_rank() OVER (ORDER BY date DESC NULLS LAST) = 1"""

SUMMARY = """
SELECT symbol, n * k AS trading_days, round(mean, 4) AS avg_close, round(lo, 4) AS min_close,
       round(hi, 4) AS max_close, round(vol, 0) AS avg_volume, latest_close, latest_date
FROM (SELECT symbol, count(*) AS n, avg(close) AS mean, min(close) AS lo, max(close) AS hi, avg(volume) AS vol
      FROM rets GROUP BY symbol)
JOIN (SELECT symbol, latest_close, latest_date, count(*) AS k FROM latest GROUP BY ALL) USING (symbol)"""


def _pivot_sql(universe) -> str:
    cols = ",\n       ".join(
        f"MAX(CASE WHEN symbol = '{u}' THEN daily_return END) AS \"{u}\"" for u in universe)
    return f"SELECT date,\n       {cols}\nFROM rets GROUP BY date"


def _corr_sql(universe) -> str:
    # Pearson's r from its definition, over the dates that both symbols have; constant series have none
    return f"""
SELECT symbol_1, symbol_2, CASE WHEN n >= 2 AND lo1 < hi1 AND lo2 < hi2 THEN round(greatest(-1.0, least(1.0,
           list_sum(list_transform(xy, lambda p: (p.x - m1) * (p.y - m2)))
           / sqrt(list_sum(list_transform(xy, lambda p: (p.x - m1) * (p.x - m1)))
                  * list_sum(list_transform(xy, lambda p: (p.y - m2) * (p.y - m2)))))), 4) END AS correlation
FROM (SELECT a.sym AS symbol_1, b.sym AS symbol_2, any_value(n) AS n, any_value(m1) AS m1, any_value(m2) AS m2,
             any_value(lo1) AS lo1, any_value(hi1) AS hi1, any_value(lo2) AS lo2, any_value(hi2) AS hi2, any_value(xy) AS xy
      FROM ({_ord_sql(universe)}) a JOIN ({_ord_sql(universe)}) b ON a.ord < b.ord
      LEFT JOIN (SELECT x.symbol AS s1, y.symbol AS s2, count(*) AS n, avg(x.daily_return) AS m1, avg(y.daily_return) AS m2,
                        min(x.daily_return) AS lo1, max(x.daily_return) AS hi1, min(y.daily_return) AS lo2,
                        max(y.daily_return) AS hi2, list({{'x': x.daily_return, 'y': y.daily_return}}) AS xy
                 FROM rets x JOIN rets y ON x.date = y.date AND x.symbol <> y.symbol GROUP BY 1, 2)
             ON s1 = a.sym AND s2 = b.sym GROUP BY 1, 2)"""


def _matrix_sql(universe) -> str:
    cells = ",\n       ".join(
        f"CASE WHEN symbol = '{u}' THEN 1.0 ELSE MAX(CASE WHEN s2 = '{u}' THEN correlation END) END"
        f" AS \"{u}\"" for u in universe)
    return ("SELECT symbol,\n       " + cells + "\nFROM (SELECT symbol_1 AS symbol, symbol_2 AS s2, "
            "correlation FROM mart UNION ALL SELECT symbol_2, symbol_1, correlation FROM mart) "
            "GROUP BY symbol ORDER BY list_position([" + ", ".join(f"'{u}'" for u in universe) + "], symbol)")


def _ord_sql(universe) -> str:
    return " UNION ALL ".join(f"SELECT '{u}' AS sym, {i} AS ord" for i, u in enumerate(universe))


CORR_KPIS = """
SELECT ROUND(AVG(correlation), 6) AS avg_correlation,
       arg_max(symbol_1, (correlation, -o1, -o2)) FILTER (WHERE correlation IS NOT NULL) AS most_symbol_1,
       arg_max(symbol_2, (correlation, -o1, -o2)) FILTER (WHERE correlation IS NOT NULL) AS most_symbol_2,
       MAX(correlation) AS most_correlation,
       arg_min(symbol_1, (correlation, o1, o2)) FILTER (WHERE correlation IS NOT NULL) AS least_symbol_1,
       arg_min(symbol_2, (correlation, o1, o2)) FILTER (WHERE correlation IS NOT NULL) AS least_symbol_2,
       MIN(correlation) AS least_correlation
FROM (SELECT m.*, a.ord AS o1, b.ord AS o2 FROM mart m
      JOIN uni a ON a.sym = m.symbol_1 JOIN uni b ON b.sym = m.symbol_2)"""


TICKS = ("SELECT event_type AS symbol, value AS price, ts AS event_time, event_id AS seq, "
         "event_id % 1000 + 1 AS volume FROM events")

TICK_CHANGE = """
SELECT symbol, event_time, seq, price, volume, LAG(price) OVER w AS prev_price,
       CASE WHEN LAG(price) OVER w IS NOT NULL AND LAG(price) OVER w <> 0
            THEN ROUND((price - LAG(price) OVER w) / LAG(price) OVER w * 100, 4) ELSE 0.0 END AS change_pct,
       CASE WHEN LAG(price) OVER w IS NULL THEN NULL
            WHEN price > LAG(price) OVER w THEN 'up'
            WHEN price < LAG(price) OVER w THEN 'down' ELSE 'flat' END AS direction
FROM ticks WINDOW w AS (PARTITION BY symbol ORDER BY event_time, seq)"""

TICK_ENCODE = """
SELECT symbol AS key,
       '{"symbol":"' || symbol || '","price":' || CAST(price AS VARCHAR)
       || ',"prev_price":' || CAST(COALESCE(prev_price, price) AS VARCHAR)
       || ',"change_pct":' || CAST(CASE WHEN COALESCE(prev_price, price) <> 0
            THEN ROUND((price - COALESCE(prev_price, price)) / COALESCE(prev_price, price) * 100, 4)
            ELSE 0.0 END AS VARCHAR)
       || ',"volume":' || CAST(volume AS VARCHAR)
       || ',"timestamp":"' || strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00"'
       || ',"source":"simulated"}' AS value
FROM chg"""


def _stats_sql(keys: str) -> str:
    return f"""
SELECT {keys}, COUNT(*) AS n_ticks, STDDEV_SAMP(price) AS volatility, AVG(price) AS avg_price,
       MAX(price) AS max_price, MIN(price) AS min_price,
       arg_max(price, (event_time, seq)) FILTER (WHERE price IS NOT NULL) AS latest_price
FROM ticks GROUP BY ALL"""


def _rules_sql(keys: str) -> str:
    m = f"""SELECT {keys}, COALESCE(volatility, 0.0) AS v, COALESCE(avg_price, 0.0) AS a,
       COALESCE(max_price, 0.0) AS mx, COALESCE(latest_price, COALESCE(avg_price, 0.0)) AS cur
FROM stats"""
    return f"""
SELECT {keys}, cur AS price_at_alert, 'HIGH_VOLATILITY' AS alert_type,
       CASE WHEN a > 0 THEN v / a ELSE 0.0 END AS metric_value, 0.02::DOUBLE AS threshold_value FROM ({m})
UNION ALL
SELECT {keys}, cur, 'PRICE_DROP', CASE WHEN mx > 0 THEN (mx - cur) / mx ELSE 0.0 END, 0.03::DOUBLE FROM ({m})
UNION ALL
SELECT {keys}, cur, 'PRICE_ANOMALY', CASE WHEN v > 0 THEN abs(cur - a) / v END, 2.0::DOUBLE FROM ({m})"""


def _id_sql(*parts: str) -> str:
    h = "sha256(concat_ws('|', " + ", ".join(parts) + "))"
    return (f"substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-' || substr({h}, 13, 4) || '-' "
            f"|| substr({h}, 17, 4) || '-' || substr({h}, 21, 12)")


ALERTS_WINDOWED = (
    "WITH ticks AS (SELECT time_bucket(INTERVAL '1 day', event_time) AS ws, * FROM ("
    + TICKS + ")),\nstats AS (" + _stats_sql("ws, symbol") + "),\nrules AS ("
    + _rules_sql("ws, symbol") + ")\nSELECT "
    + _id_sql("symbol", "alert_type", "CAST(ws AS VARCHAR)")
    + """ AS alert_id, symbol, alert_type, ROUND(metric_value, 6) AS metric_value,
       threshold_value, price_at_alert, ws + INTERVAL 1 DAY AS triggered_at
FROM rules WHERE metric_value > threshold_value""")


RECENT = """
SELECT alert_id, symbol, alert_type, round(metric_value, 4) AS metric_value,
       round(threshold_value, 4) AS threshold_value, round(price_at_alert, 4) AS price_at_alert, triggered_at
FROM (SELECT *, row_number() OVER (ORDER BY triggered_at DESC NULLS LAST, alert_id) AS nth FROM alerts_t)
WHERE nth <= 200 ORDER BY nth"""

FILTERED = ("SELECT * FROM recent WHERE symbol IN ('click', 'purchase', 'view') "
            "AND alert_type IN ('PRICE_DROP', 'HIGH_VOLATILITY')")


def _r2(x: str) -> str:
    # the mart holds 4-place values; round those decimals half away from zero
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38, 4)), 2) AS DOUBLE)"


RISK_FIGURES = {"ann_volatility_pct": "annual_volatility_pct", "var_95_daily_pct": "var_95_pct",
                **{c: c for c in ("sharpe_ratio", "max_drawdown_pct", "max_daily_gain_pct", "max_daily_loss_pct")}}
RISK_REPORT = ("SELECT symbol, " + ", ".join(f"{_r2(x)} AS {c}" for c, x in RISK_FIGURES.items())
               + " FROM mart ORDER BY symbol")

RISK_KPIS = """
SELECT ROUND(AVG(ann_volatility_pct), 6) AS avg_ann_volatility_pct,
       ROUND(AVG(var_95_daily_pct), 6) AS avg_var_95_pct,
       arg_min(symbol, (-sharpe_ratio, symbol)) FILTER (WHERE sharpe_ratio IS NOT NULL) AS best_sharpe_symbol,
       arg_min(symbol, (-max_drawdown_pct, symbol)) FILTER (WHERE max_drawdown_pct IS NOT NULL)
           AS worst_drawdown_symbol
FROM report"""

OVERVIEW = """
SELECT symbol, latest_price, avg_price, total_volume, vs_avg_pct,
       CASE WHEN vs_avg_pct > 0 THEN 'positive' WHEN vs_avg_pct < 0 THEN 'negative'
            WHEN vs_avg_pct = 0 THEN 'zero' END AS vs_avg_sign
FROM (SELECT *, ROUND((latest_price - avg_price) / NULLIF(avg_price, 0) * 100, 2) AS vs_avg_pct
      FROM (SELECT symbol, ROUND(latest_close, 4) AS latest_price, ROUND(avg_close, 4) AS avg_price,
                   avg_volume AS total_volume FROM summary)) ORDER BY symbol"""

PORTFOLIO_KPIS = """
SELECT SUM(total_volume) AS total_volume,
       arg_min(symbol, (-total_volume, symbol)) FILTER (WHERE total_volume IS NOT NULL) AS top_volume_symbol,
       COUNT(*) FILTER (WHERE vs_avg_pct > 0) AS above_avg, COUNT(*) AS n_symbols
FROM overview"""


RAW_OR = """
SELECT CAST(o_orderdate AS DATE) AS date, o_totalprice AS open, o_totalprice AS high,
       o_totalprice AS low, o_totalprice AS close, CAST(1 AS BIGINT) AS volume,
       'C' || CAST(o_custkey % 8 AS VARCHAR) AS symbol,
       TIMESTAMP '2024-01-01 00:00:00' + to_seconds(o_orderkey) AS ingested_at
FROM orders"""

DEDUP = """
SELECT * FROM raw
QUALIFY row_number() OVER (PARTITION BY symbol, date ORDER BY ingested_at DESC) = 1"""

ODD_TICKS = f"""SELECT symbol, price, volume, CASE WHEN seq % 10 <> 0 THEN event_time END AS event_time,
       seq * 90000000000000 AS seq FROM ({TICKS})"""

RAW_CORRECTED = f"""{RAW_OR} UNION ALL
SELECT date, open, high, low, close + 1, volume, symbol,
       TIMESTAMP '{REFETCH_TS}' + to_microseconds(CAST(round((close + 1) * 1000000) AS BIGINT)) FROM ({RAW_OR})
WHERE date BETWEEN DATE '{CORRECTED[0]}' AND DATE '{CORRECTED[1]}'"""

NTH = "(second(ingested_at) + 60 * minute(ingested_at)) % 50"
BAR_COLS = "date, open, high, low, close, volume, symbol"
RAW_COLS = "date, open, high, low, close, volume, symbol, ingested_at"


def _dq_sql() -> str:
    from marketlens.operators.quality import SUITE
    parts = []
    for c in SUITE:
        head = f"SELECT '{c.model}' AS model, '{c.column}' AS column_name, '{c.test}' AS test, "
        if c.test == "not_null":
            parts.append(head + f"COUNT(*) FILTER (WHERE {c.column} IS NULL) AS failures FROM {c.model}")
        elif c.test == "expression":
            parts.append(head + f"COUNT(*) FILTER (WHERE NOT ({c.expression})) AS failures FROM {c.model}")
        elif c.test == "accepted_values":
            vals = ", ".join(f"'{v}'" for v in c.values)
            parts.append(head + f"COUNT(*) FILTER (WHERE {c.column} NOT IN ({vals})) AS failures "
                                f"FROM {c.model}")
        else:
            parts.append(head + f"(SELECT COUNT(*) FROM (SELECT {c.column} FROM {c.model} "
                                f"WHERE {c.column} IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1)) "
                                "AS failures")
    parts.append("SELECT 'mart_correlation', 'correlation', 'assert_correlation_range', "
                 "COUNT(*) FROM mart_correlation WHERE correlation < -1 OR correlation > 1")
    return "\nUNION ALL\n".join(parts)


def _quarantine_sql() -> str:
    from marketlens.operators.quality import SUITE
    parts = []
    for model in dict.fromkeys(c.model for c in SUITE if c.model != "mart_correlation"):
        tests = []
        for c in SUITE:
            if c.model == model and c.test != "unique":
                bad = {"not_null": f"{c.column} IS NULL", "expression": f"NOT ({c.expression})",
                       "accepted_values": f"{c.column} NOT IN ({', '.join(repr(v) for v in c.values)})"}[c.test]
                tests.append(f"CASE WHEN {bad} THEN '{c.column} {c.test}' END")
        parts.append(f"SELECT '{model}' AS model, symbol, concat_ws(',', {', '.join(tests)}) AS failed_tests FROM {model}")
    return "SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE failed_tests <> ''"


def _with(*ctes: tuple[str, str], body: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in ctes) + "\n" + body


def _chain(bars_sql: str, *extra: tuple[str, str]):
    return (("bars", bars_sql), ("daily", DAILY), ("rets", RETS), ("runmax", RUNMAX)) + extra


U_OR, U_EV = fx.ORDERS_UNIVERSE, fx.EVENTS_UNIVERSE


def oracle_sql() -> dict[str, str]:
    o, e = _chain(BARS_OR), _chain(BARS_EV)
    p = (("raw", RAW_OR), ("bars", DEDUP)) + _chain(BARS_OR)[1:]
    models = p + (("int_stock_daily", "SELECT * FROM daily"), ("mart_risk_metrics", RISK),
                  ("latest", LATEST), ("mart_portfolio_summary", SUMMARY),
                  ("mart_correlation", _corr_sql(U_OR)))
    clean = dict((*models, ("raw_stock_prices", "SELECT * FROM raw"), ("risk_alerts", ALERTS_WINDOWED)))
    dirty = tuple((f"clean_{k}" if k in fx.DIRTY else k, v) for k, v in models
                  if k not in ("latest", "mart_portfolio_summary"))
    dirty += (("clean_raw_stock_prices", clean["raw_stock_prices"]), ("clean_risk_alerts", ALERTS_WINDOWED),
              ("clean_mart_portfolio_summary", f"SELECT * FROM ({_with(*e, ('latest', LATEST), body=SUMMARY)})"))
    dirty += tuple((m, "SELECT * REPLACE (" + ", ".join(f"{x} AS {c}" for c, x in cols.items()) + f") FROM clean_{m}")
                   for m, cols in fx.DIRTY.items())
    own = {
        "daily_returns": _with(*o, body="SELECT * FROM daily"),
        "daily_returns_dense": _with(*e, body="SELECT * FROM daily"),
        "running_max": _with(*o, body="SELECT symbol, date, close, rolling_max FROM runmax"),
        "max_drawdown": _with(*o, body="""SELECT symbol,
            ROUND(MAX((rolling_max - close) / NULLIF(rolling_max, 0)) * 100, 4) AS max_drawdown_pct
            FROM runmax GROUP BY symbol"""),
        "var_95": _with(*o, body="""SELECT symbol,
            ROUND(PERCENTILE_CONT(0.05) WITHIN GROUP (ORDER BY daily_return) * 100, 4) AS var_95_pct
            FROM rets GROUP BY symbol"""),
        "mart_risk_metrics": _with(*o, body=RISK),
        "mart_risk_metrics_dense": _with(*e, body=RISK),
        "daily_returns_bucketed": _with(*o, body="SELECT * FROM daily"),
        "running_max_bucketed": _with(*o, body="SELECT symbol, date, close, rolling_max FROM runmax"),
        "mart_risk_metrics_bucketed": _with(*o, body=RISK),
        "risk_ranking": _with(*o, ("mart", RISK),
                              body="SELECT * FROM mart ORDER BY annual_volatility_pct DESC NULLS LAST, symbol"),
        "latest_prices": _with(*o, body=LATEST),
        "mart_portfolio_summary": _with(*o, ("latest", LATEST), body=SUMMARY),
        "mart_portfolio_summary_dense": _with(*e, ("latest", LATEST), body=SUMMARY),
        "returns_pivot": _with(*o, body=_pivot_sql(U_OR)),
        "mart_correlation": _with(*o, body=_corr_sql(U_OR)),
        "mart_correlation_universe": _with(*o, body=_corr_sql(U_OR)),
        "pipeline_universe": _with(*o, body=_corr_sql([u for u in U_OR if u not in SWITCHED_OFF])),
        "universe_pruned": _with(("bars", BARS_OR), body="SELECT symbol, date, close, volume FROM bars WHERE symbol NOT IN ("
                                 + ", ".join(f"'{u}'" for u in SWITCHED_OFF) + ")"),
        "mart_correlation_dense": _with(*e, body=_corr_sql(U_EV)),
        "correlation_ranked": _with(*o, ("mart", _corr_sql(U_OR)),
                                    body="SELECT * FROM mart ORDER BY correlation DESC NULLS LAST, symbol_1, symbol_2"),
        "correlation_matrix": _with(*o, ("mart", _corr_sql(U_OR)),
                                    body=_matrix_sql(U_OR)),
        "correlation_kpis": _with(*o, ("mart", _corr_sql(U_OR)),
                                  ("uni", _ord_sql(U_OR)), body=CORR_KPIS),
        "tick_parse": "SELECT event_type AS symbol, value AS price, ts AS event_time FROM events",
        "tick_encode": _with(("ticks", TICKS), ("chg", TICK_CHANGE), body=TICK_ENCODE),
        "tick_change": _with(("ticks", TICKS), body=TICK_CHANGE),
        "tick_latest": _with(("ticks", TICKS), body="""SELECT symbol,
            arg_max(price, (event_time, seq)) FILTER (WHERE price IS NOT NULL) AS latest_price,
            arg_max(event_time, (event_time, seq)) FILTER (WHERE price IS NOT NULL) AS latest_time
            FROM ticks GROUP BY symbol"""),
        "tick_stats": _with(("ticks", TICKS), ("stats", _stats_sql("symbol")), body="""
            SELECT symbol, n_ticks, ROUND(volatility, 6) AS volatility, ROUND(avg_price, 6) AS avg_price,
                   max_price, min_price, latest_price FROM stats"""),
        "batch_alerts": _with(("ticks", TICKS), ("stats", _stats_sql("symbol")),
                              ("rules", _rules_sql("symbol")), body="""
            SELECT symbol, alert_type, ROUND(metric_value, 6) AS metric_value, threshold_value,
                   price_at_alert FROM rules WHERE metric_value > threshold_value"""),
        "alerts": ALERTS_WINDOWED,
        "recent_alerts": _with(("alerts_t", ALERTS_WINDOWED), body=RECENT),
        "alert_kpis": _with(("alerts_t", ALERTS_WINDOWED), ("recent", RECENT), body="""
            SELECT COUNT(*) AS total_alerts, COUNT(DISTINCT symbol) AS symbols_affected,
                   MAX(triggered_at) AS latest_alert FROM recent"""),
        "alerts_filtered": _with(("alerts_t", ALERTS_WINDOWED), ("recent", RECENT), body=FILTERED),
        "alert_filter_values": _with(("alerts_t", ALERTS_WINDOWED), ("recent", RECENT), body="""
            SELECT DISTINCT 'symbol' AS field, symbol AS value FROM recent
            UNION SELECT DISTINCT 'alert_type', alert_type FROM recent ORDER BY 1, 2"""),
        "alert_severity": _with(("alerts_t", ALERTS_WINDOWED), ("recent", RECENT), body="""
            SELECT *, CASE WHEN lower(alert_type) LIKE '%high%' OR lower(alert_type) LIKE '%breach%'
                                OR lower(alert_type) LIKE '%loss%' THEN 'high'
                           WHEN lower(alert_type) LIKE '%warn%' OR lower(alert_type) LIKE '%medium%'
                                THEN 'medium' ELSE 'low' END AS severity FROM recent"""),
        "alerts_by_symbol": _with(("alerts_t", ALERTS_WINDOWED), ("recent", RECENT),
                                  ("filtered", FILTERED), body="""
            SELECT symbol, COUNT(*) AS n_alerts FROM filtered GROUP BY symbol
            ORDER BY n_alerts DESC, symbol"""),
        "alerts_by_symbol_all": _with(("alerts_t", ALERTS_WINDOWED), ("recent", RECENT), body="""
            SELECT symbol, COUNT(*) AS n_alerts FROM recent GROUP BY symbol
            ORDER BY n_alerts DESC, symbol"""),
        "alerts_timeline": _with(("alerts_t", ALERTS_WINDOWED), ("recent", RECENT),
                                 ("filtered", FILTERED), body="""
            SELECT date_trunc('minute', triggered_at) AS minute, COUNT(*) AS n_alerts
            FROM filtered GROUP BY 1 ORDER BY 1"""),
        "risk_report": _with(*o, ("mart", RISK), body=RISK_REPORT),
        "risk_kpis": _with(*o, ("mart", RISK), ("report", RISK_REPORT), body=RISK_KPIS),
        "portfolio_overview": _with(*o, ("latest", LATEST), ("summary", SUMMARY), body=OVERVIEW),
        "portfolio_kpis": _with(*o, ("latest", LATEST), ("summary", SUMMARY), ("overview", OVERVIEW),
                                body=PORTFOLIO_KPIS),
        "portfolio_overview_dense": _with(*e, ("latest", LATEST), ("summary", SUMMARY), body=OVERVIEW),
        "portfolio_display": _with(*e, ("latest", LATEST), ("summary", SUMMARY), ("overview", OVERVIEW),
                                   body="""SELECT symbol, printf('%.4f', latest_price) AS latest_price_text,
            printf('%.4f', avg_price) AS avg_price_text,
            format('{:,.0f}', total_volume) AS total_volume_text,
            printf('%.1fM', total_volume / 1e6) AS total_volume_label,
            printf('%+.2f%%', vs_avg_pct) AS vs_avg_text FROM overview ORDER BY symbol"""),
        "portfolio_kpis_display": _with(*e, ("latest", LATEST), ("summary", SUMMARY),
                                        ("overview", OVERVIEW), ("kpis", PORTFOLIO_KPIS), body="""
            SELECT format('{:,.0f}', total_volume) AS total_volume_text, top_volume_symbol,
                   printf('%d / %d', above_avg, n_symbols) AS above_avg_text FROM kpis"""),
        "stg_prices": _with(("raw", RAW_OR), body=f"SELECT {RAW_COLS} FROM raw"),
        "raw_load": RAW_OR,
        "load_audit": _with(("raw", RAW_OR), body="""SELECT COUNT(*) AS n_rows, MIN(date) AS min_date,
            MAX(date) AS max_date, COUNT(DISTINCT symbol) AS n_symbols FROM raw"""),
        "nanos_to_date": """SELECT o_orderkey,
            (CAST(o_orderdate AS DATE) - DATE '1970-01-01') * 86400000000000 AS nanos,
            CAST(o_orderdate AS DATE) AS date FROM orders""",
        "ingest_normalise": _with(("bars", BARS_OR), body=f"""SELECT date, open, high, low, close,
            volume, symbol, TIMESTAMP '{REFETCH_TS}' AS ingested_at FROM bars"""),
        "ingest_directory": _with(("bars", BARS_OR), body=f"""SELECT date, open, high, low, close,
            volume, symbol, TIMESTAMP '{REFETCH_TS}' AS ingested_at FROM bars"""),
        "ingest_preview": _with(("bars", BARS_OR), body=f"""SELECT date, open, high, low, close,
            volume, symbol, TIMESTAMP '{REFETCH_TS}' AS ingested_at FROM bars
            ORDER BY list_position({list(U_OR)!r}, symbol), date LIMIT 10"""),
        "lookback_slice": _with(("raw", RAW_OR), body=f"""SELECT * FROM raw
            WHERE date >= DATE '{RUN_DATE}' - 365 AND date < DATE '{RUN_DATE}'"""),
        "universe_filter": _with(("raw", RAW_OR), body="SELECT * FROM raw WHERE symbol IN ("
                                 + ", ".join(f"'{u}'" for u in UNIVERSE_SUBSET) + ")"),
        "dedup_latest": _with(("raw", RAW_OR), body=DEDUP),
        "rerun_overwrite": _with(("raw", RAW_OR), body=f"""
            SELECT * FROM raw WHERE date_trunc('month', date) <> DATE '{RERUN_DT}'
            UNION ALL
            SELECT date, open, high, low, close, volume, symbol, TIMESTAMP '{REFETCH_TS}'
            FROM raw WHERE date_trunc('month', date) = DATE '{RERUN_DT}'"""),
        "partitioned_roundtrip": _with(("raw", RAW_OR), body=f"""SELECT {RAW_COLS},
            CAST(date_trunc('month', date) AS DATE) AS dt FROM raw"""),
        "int_stock_daily": _with(*p, body="SELECT * FROM daily"),
        "materialise": _with(*p, body=RISK),
        "dq_report": _with(*models, ("raw_stock_prices", "SELECT * FROM raw"),
                           ("risk_alerts", ALERTS_WINDOWED), body=_dq_sql()),
        "dq_report_dirty": _with(*dirty, body=_dq_sql()),
        "dq_report_written": _with(*dirty, body=_dq_sql()),
        "dq_quarantine": _with(*dirty, body=_quarantine_sql()),
        "var_95_sketched": _with(("ticks", TICKS), body="""
            SELECT symbol, COUNT(r) AS n, MIN(r) AS least, MAX(r) AS most, true AS bounded, true AS within_error
            FROM (SELECT symbol, round((price - prev) / nullif(prev, 0), 6) AS r
                  FROM (SELECT symbol, price, lag(price) OVER (PARTITION BY symbol ORDER BY event_time, seq) AS prev FROM ticks))
            WHERE r IS NOT NULL GROUP BY symbol"""),
        "dq_gate": _with(*dirty, ("report", _dq_sql()), body="""
            SELECT bool_or(failures > 0 OR model = 'risk_alerts') AS raised,
                   COUNT(*) FILTER (WHERE failures > 0 AND model <> 'risk_alerts') AS n_failed,
                   COUNT(*) FILTER (WHERE model = 'risk_alerts') AS n_not_run FROM report"""),
        "dq_unique_dirty": _with(*dirty, body="""SELECT symbol AS value, COUNT(*) AS n FROM mart_risk_metrics
            WHERE symbol IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1"""),
        "dq_accepted_values_dirty": _with(*dirty, body="""SELECT alert_id, alert_type
            FROM risk_alerts WHERE alert_type NOT IN ('HIGH_VOLATILITY', 'PRICE_DROP', 'PRICE_ANOMALY')"""),
        "dq_correlation_range_dirty": _with(*dirty, body="""SELECT * FROM mart_correlation
            WHERE correlation NOT BETWEEN -1 AND 1"""),
        "tick_parse_dirty": """SELECT event_type AS symbol, value AS price, event_id % 1000 + 1 AS volume,
            ts AS event_time FROM events WHERE event_type <> 'click'""",
        "tick_change_odd": _with(("ticks", ODD_TICKS), body=TICK_CHANGE.replace(
            "ORDER BY event_time, seq", "ORDER BY event_time NULLS FIRST, seq")),
        "tick_latest_odd": _with(("ticks", ODD_TICKS), body="""
            SELECT symbol, price AS latest_price,
                   max(event_time) OVER (PARTITION BY symbol) AS latest_time
            FROM ticks QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY event_time DESC NULLS LAST, seq DESC) = 1"""),
        "dedup_null_ingest": _with(("bars", BARS_OR), ("loads", f"""
            SELECT {BAR_COLS}, NULL::TIMESTAMP AS ingested_at FROM bars UNION ALL
            SELECT {BAR_COLS.replace('close', 'close + 1 AS close')}, TIMESTAMP '{REFETCH_TS}'
            FROM bars WHERE day(date) % 2 = 1"""), body="""SELECT * FROM loads
            QUALIFY row_number() OVER (PARTITION BY symbol, date ORDER BY ingested_at DESC NULLS LAST) = 1"""),
        "rerun_removed": _with(("raw", RAW_OR), body=f"""SELECT COUNT(*) AS removed, 0::BIGINT AS removed_new_date
            FROM raw WHERE date_trunc('month', date) = DATE '{RERUN_DT}'"""),
        "load_pruned": _with(("raw", RAW_OR), body="""SELECT * FROM raw
            WHERE date >= DATE '1995-02-10' AND date < DATE '1995-06-01'"""),
        "pipeline_lookback": _with(("raw", f"""SELECT * FROM ({RAW_OR})
            WHERE date >= DATE '1997-01-01' - 365 AND date < DATE '1997-01-01'"""), *p[1:],
            body="SELECT * FROM daily"),
        "universe_bars": _with(("bars", BARS_OR), ("uni", _ord_sql(UNIVERSE_SUBSET)), body="""
            SELECT symbol, ord, COUNT(*) AS n_bars FROM bars JOIN uni ON sym = symbol GROUP BY ALL"""),
        "risk_kpis_display": _with(*o, ("mart", RISK), ("report", RISK_REPORT), ("kpis", RISK_KPIS), body="""
            SELECT printf('%.1f%%', avg_ann_volatility_pct) AS avg_ann_volatility_text,
                   printf('%.2f%%', avg_var_95_pct) AS avg_var_95_text, best_sharpe_symbol, worst_drawdown_symbol
            FROM kpis"""),
        "alert_kpis_display": _with(("alerts_t", ALERTS_WINDOWED), ("recent", RECENT), body="""
            SELECT COUNT(*) AS total_alerts, COUNT(DISTINCT symbol) AS symbols_affected,
                   coalesce(strftime(MAX(triggered_at), '%Y-%m-%d %H:%M'), '-') AS latest_alert_text FROM recent"""),
        "correlation_kpis_display": _with(*o, ("mart", _corr_sql(U_OR)),
                                          ("uni", _ord_sql(U_OR)), ("kpis", CORR_KPIS), body="""
            SELECT printf('%.4f', avg_correlation) AS avg_correlation_text,
                   most_symbol_1 || ' / ' || most_symbol_2 AS most_pair_text,
                   printf('%.4f', most_correlation) AS most_correlation_text,
                   least_symbol_1 || ' / ' || least_symbol_2 AS least_pair_text,
                   printf('%.4f', least_correlation) AS least_correlation_text FROM kpis"""),
        "dq_unique": _with(*models, body="""
            SELECT 'mart_risk_metrics' AS model, symbol AS value, COUNT(*) AS n FROM mart_risk_metrics
            WHERE symbol IS NOT NULL GROUP BY symbol HAVING COUNT(*) > 1
            UNION ALL
            SELECT 'mart_portfolio_summary', symbol, COUNT(*) FROM mart_portfolio_summary
            WHERE symbol IS NOT NULL GROUP BY symbol HAVING COUNT(*) > 1"""),
        "dq_accepted_values": _with(("alerts_t", ALERTS_WINDOWED), body="""SELECT alert_id, alert_type
            FROM alerts_t WHERE alert_type NOT IN ('HIGH_VOLATILITY', 'PRICE_DROP', 'PRICE_ANOMALY')"""),
        "dq_correlation_range": _with(*models, body="""SELECT * FROM mart_correlation
            WHERE correlation < -1 OR correlation > 1"""),
        "json_load": _with(("raw", RAW_OR), body=f"""SELECT * REPLACE (CASE WHEN {NTH} = 3 THEN NULL ELSE volume END AS volume)
            FROM raw WHERE {NTH} NOT IN (0, 1, 2, 5)"""),
        "json_rejected": _with(("raw", RAW_OR), body=f"""SELECT reasons, COUNT(*) AS n_lines FROM (
            SELECT CASE {NTH} WHEN 2 THEN 'close: no double' WHEN 5 THEN 'date: no bigint, volume: no bigint'
                        ELSE 'no JSON object' END AS reasons FROM raw WHERE {NTH} IN (0, 1, 2, 5)) GROUP BY reasons"""),
        "incremental_load": RAW_OR,
        "incremental_history": _with(("raw", RAW_OR), body=f"""
            SELECT CASE WHEN dt < DATE '{SECOND_RUN}' THEN 0 ELSE 1 END::BIGINT AS batch_id, dt, COUNT(*) AS n_rows,
                   MIN(date) AS min_date, MAX(date) AS max_date
            FROM (SELECT *, CAST(date_trunc('month', date) AS DATE) AS dt FROM raw) GROUP BY dt"""),
        "incremental_risk": _with(*p, body=RISK),
        "incremental_summary": _with(*p, ("latest", LATEST), body=SUMMARY),
        "incremental_correlation": _with(*p, body=_corr_sql(U_OR)),
        "incremental_risk_corrected": _with(("raw", RAW_CORRECTED), *p[1:], body=RISK),
        "incremental_correlation_corrected": _with(("raw", RAW_CORRECTED), *p[1:], body=_corr_sql(U_OR)),
        "tick_stream": "SELECT event_type AS symbol, value AS price, ts AS event_time FROM events",
        "tick_change_streamed": _with(("ticks", TICKS), body=TICK_CHANGE),
        "stream_quiet": _with(
            ("ticks", f"SELECT * FROM ({TICKS}) QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY event_time) = 1"),
            ("stats", _stats_sql("symbol")), ("rules", _rules_sql("symbol")), body="""
            SELECT COUNT(*) AS total_alerts, COUNT(DISTINCT symbol) AS symbols_affected, NULL::TIMESTAMP AS latest_alert
            FROM rules WHERE metric_value > threshold_value"""),
        "stream_compacted": ALERTS_WINDOWED,
        "recent_alerts_compacted": _with(("alerts_t", ALERTS_WINDOWED), body=RECENT),
        "recent_alerts_newest_days": _with(("alerts_t", ALERTS_WINDOWED), body=RECENT),
        "stream_alerts": _with(("ticks", TICKS), ("stats", _stats_sql("symbol")),
                               ("rules", _rules_sql("symbol")), body="""
            SELECT symbol, alert_type, ROUND(metric_value, 6) AS metric_value, threshold_value,
                   price_at_alert FROM rules WHERE metric_value > threshold_value"""),
        "stream_alerts_windowed": ALERTS_WINDOWED,
        "stream_restart": ALERTS_WINDOWED,
        "stream_alerts_unordered": ALERTS_WINDOWED,
        "stream_alerts_two_runs": _with(
            ("ticks", f"SELECT *, seq % 2 AS half FROM ({TICKS})"), ("stats", _stats_sql("half, symbol")),
            ("rules", _rules_sql("half, symbol")), body="""
            SELECT symbol, alert_type, ROUND(metric_value, 6) AS metric_value, threshold_value,
                   price_at_alert FROM rules WHERE metric_value > threshold_value"""),
        "stream_windowed_two_runs": ALERTS_WINDOWED,
        "recent_alerts_streamed": _with(("alerts_t", ALERTS_WINDOWED), body=RECENT),
    }
    for module in EXTRA:
        own |= module.oracle_sql()
    return own
