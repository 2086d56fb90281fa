"""The batch plan: raw bars -> staging -> daily returns -> marts -> tests.

Each model is a function of the models it references, so ``build_models``
is plain composition and Catalyst plans one query per mart.  ``run_batch``
materialises the core table once (written and read back, which also cuts
the lineage the three marts share), writes the marts and the alerts as
full-refresh tables, runs the tests on the stored tables and gates on the
stored report.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.operators import correlation as corr
from marketlens.operators import quality, risk
from marketlens.operators.returns import RISK_INPUT, SUMMARY_INPUT, daily_returns, stg_prices
from marketlens.sources.bars import dedup_latest, lookback_slice, materialise, stage_view


def build_models(raw: DataFrame, universe: corr.Universe, dedup: bool = True) -> dict[str, DataFrame]:
    """Lazy models; ``dedup`` keeps the newest load of each (symbol, date)."""
    base = dedup_latest(raw) if dedup else raw
    stg = stg_prices(base)
    daily = daily_returns(stg)
    return {
        "stg_stock_prices": stg,
        "int_stock_daily": daily,
        "mart_risk_metrics": risk.risk_metrics(daily_returns(stg, keep_segment=True, columns=RISK_INPUT)),
        "mart_portfolio_summary": risk.portfolio_summary(daily_returns(stg, columns=SUMMARY_INPUT), stg, unique_bars=dedup),
        "mart_correlation": corr.correlation(daily_returns(stg, columns=RISK_INPUT), universe, unique_bars=dedup),
    }


#: The folder of each model group under the output folder.
LAYERS = {"int_stock_daily": "core", "mart_risk_metrics": "marts", "mart_portfolio_summary": "marts",
          "mart_correlation": "marts", "risk_alerts": "alerts", "quality_report": "quality"}


def model_path(out_dir: str, model: str) -> str:
    return f"{out_dir.rstrip('/')}/{LAYERS[model]}/{model}"


def read_model(spark: SparkSession, out_dir: str, model: str) -> DataFrame:
    """A stored model, as the report pages read it."""
    return spark.read.parquet(model_path(out_dir, model)).drop(quality.FAILED_TESTS, quality.QUARANTINED)


def run_batch(raw: DataFrame, universe: corr.Universe, out_dir: str, alerts: DataFrame | None = None,
              gate: bool = True, run_date: str | None = None, days: int = 365, quarantine: bool = False) -> dict[str, DataFrame]:
    """Materialise every model under ``out_dir`` (a folder per layer) and run the test suite.

    ``universe`` is the configured symbols, in order or as a table (``sources.universe``).
    With ``run_date`` the run covers the ``days`` before it.  With ``quarantine`` rows are
    tested while they are written: failing rows are in the table ``quarantine`` too, with
    their model and tests, and stored models carry the layout of ``quality.write_checked``
    (read them by ``read_model``).  Returns the read-back
    tables plus the stored ``quality_report``; raises ``DataQualityError`` when
    ``gate`` is set and a test fails or, its model missing, wasn't run.
    """
    if run_date is not None:
        raw = lookback_slice(raw, run_date, days)
    base = dedup_latest(raw)
    stg = stage_view(stg_prices(base), "stg_stock_prices")
    # the core table is laid out by bar year: date-range reads prune folders
    checked = {}

    def store(df, model, partition_by=None):
        path = model_path(out_dir, model)
        if not quarantine:
            return materialise(df, path, partition_by)
        checked[model] = quality.write_checked(df, path, model, partition_by)
        return checked[model].table

    daily = store(daily_returns(stg).withColumn("year", F.year("date")), "int_stock_daily", "year").drop("year")
    models = {
        "mart_risk_metrics": risk.risk_metrics(daily),
        "mart_portfolio_summary": risk.portfolio_summary(daily, unique_bars=True),
        "mart_correlation": corr.correlation(daily, universe, unique_bars=True),
    }
    if alerts is not None:
        models["risk_alerts"] = alerts
    # they only read stored tables: write them as concurrent jobs
    with ThreadPoolExecutor(max_workers=len(models)) as pool:
        done = {name: pool.submit(store, df, name) for name, df in models.items()}
        tables = {"int_stock_daily": daily, **{name: f.result() for name, f in done.items()}}
    if quarantine:
        # the raw rows are not a model of this run: their tests are one pass over them
        raw_tests = quality.quality_report({"raw_stock_prices": raw}, singular=False).filter("model = 'raw_stock_prices'")
        written = quality.checked_report(checked).filter("model <> 'raw_stock_prices'")
        report = materialise(written.unionByName(raw_tests), model_path(out_dir, "quality_report"))
        tables["quarantine"] = quality.quarantined(checked)
    else:
        report = materialise(quality.quality_report({"raw_stock_prices": raw, **tables}),
                             model_path(out_dir, "quality_report"))
    if gate:
        quality.assert_quality(report)
    tables["quality_report"] = report
    return tables
