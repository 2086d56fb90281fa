"""Compare a ``queries()`` entry with its ``oracle_sql()`` text on DuckDB.

Columns are sorted by name, values normalised (floats rounded to 9
significant digits, NaN -> NULL, dates/timestamps to ISO text) and rows
compared as multisets - the same shape of check the driver records.
"""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(f"{v:.9g}")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat(sep=" ") if isinstance(v, dt.datetime) else v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    try:
        import decimal
        if isinstance(v, decimal.Decimal):
            return float(f"{float(v):.9g}")
    except Exception:  # pragma: no cover
        pass
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [tuple(_norm(r[i]) for i in order) for r in rows]


#: Keys whose result is an ordered page: rows are compared in their order.
ORDERED = {"risk_ranking", "risk_report", "correlation_ranked", "alert_filter_values", "alerts_by_symbol",
           "alerts_by_symbol_all", "alerts_timeline", "portfolio_overview", "portfolio_overview_dense",
           "portfolio_display", "recent_alerts", "recent_alerts_streamed", "recent_alerts_compacted", "recent_alerts_newest_days", "ingest_preview", "correlation_matrix"}


def compare(spark, con, fn, sql, sf_dir, ordered=False):
    sdf = fn(spark, sf_dir)
    s_names = sdf.columns
    s_rows = rows_of(s_names, [tuple(r) for r in sdf.collect()])
    res = con.execute(sql)
    d_names = [d[0] for d in res.description]
    d_rows = rows_of(d_names, res.fetchall())
    info = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
            "schema_ok": sorted(s_names) == sorted(d_names)}
    info["values_ok"] = info["schema_ok"] and (s_rows == d_rows if ordered else Counter(s_rows) == Counter(d_rows))
    if not info["values_ok"]:
        info["spark_cols"], info["oracle_cols"] = sorted(s_names), sorted(d_names)
        diff_s = list((Counter(s_rows) - Counter(d_rows)).elements())[:3]
        diff_d = list((Counter(d_rows) - Counter(s_rows)).elements())[:3]
        info["only_spark"], info["only_oracle"] = diff_s, diff_d
    return info
