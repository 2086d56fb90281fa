"""Helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.session import scratch_dir

#: Spark's setting by which an execution's shuffle files go when it ends.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str, compression: str = "snappy", freed: bool = False) -> DataFrame:
    """Write ``df`` to a fresh shared folder and return it read back.

    Cuts the lineage: later stages survive lost executors without recomputing,
    values that depend on task layout are fixed, and Spark knows the real size.
    If ``freed``, the write's shuffle files, which nothing reads again, go at its end and
    not when the driver next collects garbage (the session's setting is put back).
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    setting = spark.conf.get(FREED, "false")
    if freed:
        spark.conf.set(FREED, "true")
    try:
        df.write.parquet(path, compression=compression)
    finally:
        if freed:
            spark.conf.set(FREED, setting)
    return spark.read.schema(df.schema).parquet(path)


def through_arrow(df: DataFrame, task, schema) -> DataFrame:
    """``mapInArrow`` for any column names (it can't take dots): the task sees columns by position."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]).mapInArrow(task, schema)


#: Rows of long texts that a task takes up, and passes on, at once.
SLICE = 1000


def slices(batches):
    """The batches in pieces of ``SLICE`` rows (views), so that what a task holds beside them stays small."""
    for batch in batches:
        for k in range(0, batch.num_rows, SLICE):
            yield batch.slice(k, SLICE)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` doesn't have yet (names compare case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def bound(expr, body):
    """``body`` of a column that is computed once (a higher-order "let")."""
    return F.get(F.transform(F.array(expr), body), F.lit(0))


def text_or_empty(col="text"):
    return F.coalesce(F.col(col), F.lit(""))


def byte_of_char() -> dict[str, int]:
    """The byte behind each printable stand-in of byte-level vocabularies.

    Printable Latin-1 characters stand for themselves; the other bytes, in
    order, for the characters from U+0100 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}
