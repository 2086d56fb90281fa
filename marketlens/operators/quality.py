"""Declarative data-quality checks (column tests and a singular test).

A test is "a query returning failing rows; zero rows = pass".  All row-level
tests of one table (not_null, expression, accepted_values) fold into a
single aggregation pass with one ``count_if`` per test; ``unique`` needs a
grouping of its own (partial aggregation on the column).  The report is one
row per test, bounded by the number of declared tests, so the gate may read
it on the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from marketlens.functions.scalar import ALERT_TYPES


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    test: str                      # not_null | unique | expression | accepted_values
    expression: str | None = None  # SQL predicate that must hold (expression tests)
    values: tuple = field(default_factory=tuple)

    def failing(self) -> Column:
        """True on a failing row (NULL predicates never fail, as in SQL)."""
        c = F.col(self.column)
        if self.test == "not_null":
            return c.isNull()
        if self.expression is not None:
            return ~F.expr(self.expression)
        if self.test == "accepted_values":
            return ~c.isin(list(self.values))
        raise ValueError(f"not a row-level test: {self.test}")


# --- the declared suite (fixed: models, columns and predicates to check) ----
ALERT_TYPE_VALUES = ALERT_TYPES
SUITE: tuple[Check, ...] = (
    Check("raw_stock_prices", "date", "not_null"),
    Check("raw_stock_prices", "symbol", "not_null"),
    Check("raw_stock_prices", "close", "not_null"),
    Check("raw_stock_prices", "close", "expression", "close >= 0"),
    Check("risk_alerts", "alert_type", "accepted_values", values=ALERT_TYPE_VALUES),
    Check("risk_alerts", "symbol", "not_null"),
    Check("risk_alerts", "triggered_at", "not_null"),
    Check("int_stock_daily", "symbol", "not_null"),
    Check("int_stock_daily", "date", "not_null"),
    Check("mart_risk_metrics", "symbol", "not_null"),
    Check("mart_risk_metrics", "symbol", "unique"),
    Check("mart_risk_metrics", "daily_volatility_pct", "not_null"),
    Check("mart_risk_metrics", "daily_volatility_pct", "expression", "daily_volatility_pct >= 0"),
    Check("mart_risk_metrics", "var_95_pct", "not_null"),
    Check("mart_risk_metrics", "var_95_pct", "expression", "var_95_pct <= 0"),
    Check("mart_portfolio_summary", "symbol", "not_null"),
    Check("mart_portfolio_summary", "symbol", "unique"),
    Check("mart_portfolio_summary", "latest_close", "not_null"),
    Check("mart_portfolio_summary", "latest_close", "expression", "latest_close >= 0"),
    Check("mart_correlation", "symbol_1", "not_null"),
    Check("mart_correlation", "symbol_2", "not_null"),
    Check("mart_correlation", "correlation", "not_null"),
    Check("mart_correlation", "correlation", "expression",
          "correlation >= -1 and correlation <= 1"),
)
# -----------------------------------------------------------------------------

REPORT_COLUMNS = ["model", "column_name", "test", "failures"]


class DataQualityError(RuntimeError):
    pass


def _row_level(model: str, df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    counts = df.agg(*[F.count_if(c.failing()).alias(f"_f{i}") for i, c in enumerate(checks)])
    rows = F.array(*[F.struct(F.lit(c.model).alias("model"), F.lit(c.column).alias("column_name"),
                              F.lit(c.test).alias("test"), F.col(f"_f{i}").alias("failures"))
                     for i, c in enumerate(checks)])
    return counts.select(F.inline(rows))


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """Duplicated non-NULL values of ``column`` with their counts."""
    return (df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value"))
            .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1))


def correlation_out_of_range(mart: DataFrame) -> DataFrame:
    """Singular test: correlations outside [-1, 1]."""
    return mart.filter((F.col("correlation") < -1) | (F.col("correlation") > 1))


def accepted_values_failures(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    return df.filter(~F.col(column).isin(list(values)))


def _unique_row(c: Check, df: DataFrame) -> DataFrame:
    n = unique_failures(df, c.column).agg(F.count(F.lit(1)).alias("failures"))
    return n.select(F.lit(c.model).alias("model"), F.lit(c.column).alias("column_name"), F.lit(c.test).alias("test"), "failures")


def _absent(checks: Sequence[tuple[str, str, str]], spark) -> DataFrame:
    """Tests whose model isn't there: one row each, failures unknown."""
    return spark.createDataFrame([(*c, None) for c in checks],
                                 "model string, column_name string, test string, failures long")


SINGULAR = ("mart_correlation", "correlation", "assert_correlation_range")


def quality_report(tables: Mapping[str, DataFrame], suite: Sequence[Check] = SUITE,
                   singular: bool = True) -> DataFrame:
    """One row per test: model, column_name, test, failures (NULL where the model is absent).

    All row-level tests of a table, the singular range test included, are one pass.
    """
    parts: list[DataFrame] = []
    spark = next(iter(tables.values())).sparkSession
    declared = [(c.model, c.column, c.test) for c in suite] + ([SINGULAR] if singular else [])
    absent = [c for c in declared if c[0] not in tables]
    if absent:
        parts.append(_absent(absent, spark))
    for model, df in tables.items():
        if checks := row_checks(model, suite, singular):
            parts.append(_row_level(model, df, checks))
        for c in suite:
            if c.model == model and c.test == "unique":
                parts.append(_unique_row(c, df))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


#: Columns that a checked write adds: the tests that a row fails, and whether it fails any (the folder).
FAILED_TESTS, QUARANTINED = "failed_tests", "quarantined"


def row_checks(model: str, suite: Sequence[Check] = SUITE, singular: bool = True) -> list[Check]:
    """The tests of a model that look at one row at a time."""
    checks = [c for c in suite if c.model == model and c.test != "unique"]
    if singular and model == SINGULAR[0]:
        checks.append(Check(*SINGULAR, expression="correlation >= -1 and correlation <= 1"))
    return checks


@dataclass(frozen=True)
class Checked:
    """A model stored with its tests: all its rows, those that fail one, and the failures by test."""
    table: DataFrame
    quarantine: DataFrame
    failures: dict[tuple[str, str, str], int]


def write_checked(df: DataFrame, path: str, model: str, partition_by: str | None = None,
                  suite: Sequence[Check] = SUITE, singular: bool = True) -> Checked:
    """Store a model and test its rows in the same pass.

    The failures are counted by the tasks that write (observed metrics, taken from successful
    tasks only), and rows that fail a test go into a folder of their own with the names
    of their tests: the quarantine is read from there, no row is written twice and
    no row-level test reads the table again.
    """
    checks = row_checks(model, suite, singular)
    seen = Observation()
    names = F.array_compact(F.array(*[F.when(c.failing(), F.lit(f"{c.column} {c.test}")) for c in checks], F.lit(None).cast("string")))
    tested = df.withColumn(FAILED_TESTS, names).withColumn(QUARANTINED, F.size(FAILED_TESTS) > 0)
    counts = [F.count_if(F.array_contains(FAILED_TESTS, f"{c.column} {c.test}")).alias(f"f{i}") for i, c in enumerate(checks)]
    layout = [c for c in (partition_by, QUARANTINED) if c]
    if partition_by:
        tested = tested.hint("rebalance", partition_by)
    (tested.observe(seen, F.count(F.lit(1)).alias("rows"), *counts)
     .write.mode("overwrite").partitionBy(*layout).parquet(path))
    found = seen.get
    stored = df.sparkSession.read.schema(tested.schema).parquet(path)
    return Checked(stored.select(*df.columns), stored.filter(QUARANTINED).select(*df.columns, FAILED_TESTS),
                   {(c.model, c.column, c.test): found[f"f{i}"] for i, c in enumerate(checks)})


def checked_report(models: Mapping[str, Checked], suite: Sequence[Check] = SUITE, singular: bool = True) -> DataFrame:
    """``quality_report`` from checked writes: only ``unique`` tests read the stored tables."""
    spark = next(iter(models.values())).table.sparkSession
    declared = [(c.model, c.column, c.test) for c in suite if c.test != "unique" or c.model not in models]
    declared += [SINGULAR] if singular else []
    known = {k: n for m in models.values() for k, n in m.failures.items()}
    out = spark.createDataFrame([(*d, known.get(d)) for d in declared],        # a row per declared test
                                "model string, column_name string, test string, failures long")
    for c in suite:
        if c.test == "unique" and c.model in models:
            out = out.unionByName(_unique_row(c, models[c.model].table))
    return out


def quarantined(models: Mapping[str, Checked]) -> DataFrame:
    """Failing rows of all models: model, tests, and the row as JSON (models have different columns)."""
    parts = [m.quarantine.select(F.lit(name).alias("model"), F.array_join(FAILED_TESTS, ",").alias(FAILED_TESTS),
                                 F.to_json(F.struct(*m.table.columns)).alias("row_json")) for name, m in models.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def assert_quality(report: DataFrame) -> DataFrame:
    """Gate: raise when any test fails or couldn't run; otherwise return the report."""
    failed = report.filter(F.col("failures").isNull() | (F.col("failures") > 0)).collect()  # a row per declared test
    if failed:
        lines = ", ".join(f"{r.model}.{r.column_name} {r.test}: "
                          f"{'not run' if r.failures is None else r.failures}" for r in failed)
        raise DataQualityError(f"{len(failed)} data-quality test(s) failed: {lines}")
    return report


def gate_outcome(report: DataFrame) -> DataFrame:
    """What the gate does with a report, as one row: raised, failing tests, tests not run."""
    return report.agg(F.coalesce(F.max(F.coalesce(F.col("failures") > 0, F.lit(True))), F.lit(False)).alias("raised"),
                      F.count_if(F.col("failures") > 0).alias("n_failed"),
                      F.count_if(F.col("failures").isNull()).alias("n_not_run"))
