"""Plan shape: no Python in the hot path, pushdown reaches the scan, few shuffles."""

import __spark_entry__ as E
from marketlens.session import scratch_dir
from marketlens.sources import bars as sb
from marketlens.sources import fixtures as fx
from tests.conftest import SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_evaluation_anywhere(spark):
    for name, fn in E.queries().items():
        if any(name in m.queries() for m in E.EXTRA) or name.startswith(("recent_alerts_streamed", "recent_alerts_compacted", "tick_change_streamed", "stream", "tick_stream", "raw_load", "rerun", "partitioned", "lookback",
                            "materialise", "load_audit", "incremental")):
            continue
        p = _plan(fn(spark, SMALL))
        correlation = "correlation" in name or name in ("dq_report_dirty", "dq_gate")   # the one named exception
        for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow"):
            assert node not in p or correlation and node == "MapInArrow", (name, node)


def test_lookback_slice_pushes_date_range(spark):
    table = sb.materialise(fx.orders_raw(spark, SMALL), scratch_dir(spark, "t_raw"))
    p = _plan(sb.lookback_slice(table, "2000-01-01"))
    assert "PushedFilters: [IsNotNull(date), GreaterThanOrEqual(date" in p


def test_universe_filter_is_pushed_in_list(spark):
    table = sb.materialise(fx.orders_raw(spark, SMALL), scratch_dir(spark, "t_raw"))
    p = _plan(sb.universe_filter(table, ["C1", "C2"]))
    assert "In(symbol" in p and "Join" not in p


def test_risk_mart_scan_is_pruned(spark):
    p = _plan(E.q_mart_risk_metrics(spark, SMALL))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double,o_orderdate" in p
    assert "o_orderpriority" not in p


def test_core_table_is_laid_out_by_year_and_pruned(spark):
    from marketlens.plans import pipeline as pl
    out_dir = scratch_dir(spark, "t_models")
    pl.run_batch(fx.orders_raw(spark, SMALL), fx.ORDERS_UNIVERSE, out_dir, gate=False)
    table = spark.read.parquet(pl.model_path(out_dir, "int_stock_daily"))
    assert "year" in table.columns
    p = _plan(sb.lookback_slice(table, "2000-01-01"))
    assert "PartitionFilters: [isnotnull(year" in p and "PushedFilters: [IsNotNull(date)" in p


def test_unbroadcast_carry_join_moves_only_the_carry(spark):
    """Without broadcasts the patch join is a sort-merge join whose row side is
    the window's (_key, _seg) exchange itself: tick_change shuffles the rows
    once; the other exchanges carry per-segment rows only."""
    import __spark_entry__ as E
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = [spark.conf.get(k, None) for k in keys]
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        df = E.queries()["tick_change"](spark, SMALL)
        df.collect()
        final = _plan(df).split("== Initial Plan ==")[0]
    finally:
        for k, v in zip(keys, old):
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    exchanges = [ln for ln in final.splitlines() if "Exchange hashpartitioning" in ln]
    assert "SortMergeJoin" in final
    assert len(exchanges) == 4, exchanges        # rows, carry partial, carry window, carry to join
    assert sum("_ck#" in ln for ln in exchanges) == 1


def _scans(df) -> int:
    df.collect()
    final = _plan(df).split("== Initial Plan ==")[0]
    return final.count("FileScan parquet") or final.count("Scan parquet")


def test_sequential_queries_read_their_source_once(spark):
    for name in ("daily_returns", "daily_returns_dense", "tick_change"):
        assert _scans(E.queries()[name](spark, SMALL)) == 1, name
    for name in ("int_stock_daily", "mart_risk_metrics", "mart_correlation", "mart_portfolio_summary", "var_95"):
        assert _scans(E.queries()[name](spark, SMALL)) == 1, name
    assert _scans(E.queries()["mart_portfolio_summary_dense"](spark, SMALL)) <= 3


def test_landing_read_prunes_folders_and_row_groups(spark):
    root = scratch_dir(spark, "t_landing")
    sb.write_landing(fx.orders_raw(spark, SMALL), root, E._month())
    p = _plan(sb.load_raw(spark, root, "1995-02-10", "1995-06-20", ("1995-01-01", "1995-05-01")))
    assert "PartitionFilters: [isnotnull(dt" in p and f"GreaterThanOrEqual(date,{9171 * sb.NANOS_PER_DAY})" in p
    import glob
    folders = glob.glob(root.replace("file:", "") + "/dt=*")
    assert len(folders) > 50
    assert all(len(glob.glob(f + "/*.parquet")) <= 2 for f in folders)


def test_kpis_over_a_stored_mart_have_no_range_exchange(spark):
    p = _plan(E.queries()["risk_kpis"](spark, SMALL))
    assert "rangepartitioning" not in p and "FileScan parquet" in p
