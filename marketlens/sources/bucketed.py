"""Daily tables stored in buckets of (symbol, year), sorted by date within a bucket.

A table so stored carries the segment columns of ``operators.sequential``:
returns, running peak and marts read it partitioned as they need it, and no row
crosses the wire again; only a carry of one row per (symbol, year) and a
symbol's aggregates do.  A symbol's years lie in different buckets, so a long or
hot history is spread.  Models computed from a bucketed table and stored with
the same number of buckets are written without an exchange, too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.operators.sequential import SEGMENT_COLUMNS, segmented_rows


def store_bucketed(daily: DataFrame, name: str, path: str, buckets: int) -> DataFrame:
    """Write ``daily`` (a bar per symbol and date, with or without the segment columns) and read it back as table ``name``.

    One file a bucket.  The columns are those of ``daily`` with ``symbol`` inside ``_key``.
    """
    if all(c in daily.columns for c in SEGMENT_COLUMNS):
        rows = daily.select(*[c for c in daily.columns if c != "symbol"])
    else:
        rows = segmented_rows(daily, "symbol", F.year("date"))
    (rows.repartition(buckets, *SEGMENT_COLUMNS).write.format("parquet")
     .bucketBy(buckets, *SEGMENT_COLUMNS).sortBy(*SEGMENT_COLUMNS, "date").option("path", path).saveAsTable(name))
    return daily.sparkSession.table(name)


def attach(spark: SparkSession, name: str, path: str, buckets: int) -> DataFrame:
    """A table that another session stored at ``path``, known here as ``name``."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    by = ", ".join(SEGMENT_COLUMNS)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}, date) "
              f"INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)
