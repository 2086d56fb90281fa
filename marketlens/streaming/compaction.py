"""Alert sinks with a bounded number of files: closed days are copied into few files and switched over.

A running query leaves a folder per day and batch, 8,640 a day at a ten-second trigger.
``compact`` copies the batches of closed days into ``<sink>_compacted/data`` (a version
of a day, a few files) and then records, in one small file under
``<sink>_compacted/commits``, which batches the version covers.  That record is the
switch: readers take the newest recorded version of a day and, of the sink itself, the
batches that it doesn't cover.

* Before the record is there, readers see the batches; after it, the copy; never both.
* A crash before the record leaves a copy that no reader looks at; the next call makes
  another version.
* A batch that is repeated, or that brings alerts of a closed day late, is covered by its
  own (run, batch) or stays in the sink until the next call makes a new version.
* ``vacuum`` removes folders of covered batches and superseded copies.  It is a step of
  its own, to be run when the readers that started before the last switch have ended;
  readers that start later don't look at what it removes.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marketlens.sources.tables import delete_folder, read_or_empty

#: One row per version of a day: what it covers.  Versions are numbered from 0.
COMMIT = "day date, version int, covered array<struct<run_id:string,batch_id:bigint>>"


def _data(sink: str) -> str:
    return f"{sink.rstrip('/')}_compacted/data"


def _commits(spark: SparkSession, sink: str) -> DataFrame:
    return read_or_empty(spark, f"{sink.rstrip('/')}_compacted/commits", StructType.fromDDL(COMMIT))


def _newest(commits: DataFrame) -> DataFrame:
    return commits.groupBy("day").agg(F.max("version").alias("version"), F.max_by("covered", "version").alias("covered"))


def _covered(commits: DataFrame) -> DataFrame:
    return commits.select("day", F.explode("covered").alias("c")).select("day", "c.run_id", "c.batch_id")


def _versioned(schema: StructType) -> StructType:
    return StructType([*schema.fields]).add("version", "integer")


def read_compacted(spark: SparkSession, sink: str, schema: StructType) -> DataFrame:
    """All rows of a sink: the newest copies of compacted days, and the batches that they don't cover."""
    newest = _newest(_commits(spark, sink))          # read before the sink: a switch meanwhile is not seen in half
    live = read_or_empty(spark, sink, schema).join(_covered(newest), ["day", "run_id", "batch_id"], "left_anti")
    copies = read_or_empty(spark, _data(sink), _versioned(schema)).join(newest.select("day", "version"), ["day", "version"], "left_semi")
    names = schema.fieldNames()
    return live.select(*names).unionByName(copies.select(*names))


def compact(spark: SparkSession, sink: str, schema: StructType, before: dt.date,
            merge: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> int:
    """Copy the days before ``before`` that have uncovered batches; the number of days copied.

    ``merge`` may leave out rows that others supersede (it must not need rows of other days)."""
    newest = _newest(_commits(spark, sink))
    live = read_or_empty(spark, sink, schema).filter(F.col("day") < F.lit(before))
    batches = live.select("day", "run_id", "batch_id").distinct()
    todo = batches.join(_covered(newest), ["day", "run_id", "batch_id"], "left_anti").select("day").distinct()
    versions = (todo.join(newest.select("day", "version"), "day", "left")
                .select("day", (F.coalesce("version", F.lit(-1)) + 1).alias("version")))
    versions = {r.day: r.version for r in versions.collect()}                   # a row per day to be copied
    if not versions:
        return 0
    # what a version covers is settled before its rows are read: a batch that comes meanwhile waits for the next
    covers = (batches.filter(F.col("day").isin(list(versions))).unionByName(_covered(newest.filter(F.col("day").isin(list(versions)))))
              .distinct().groupBy("day").agg(F.collect_list(F.struct("run_id", "batch_id")).alias("covered")))
    covers = covers.select("day", _version_of(versions), "covered").persist()
    try:
        covers.count()
        rows = read_compacted(spark, sink, schema).filter(F.col("day").isin(list(versions)))
        rows = rows.join(_covered(covers), ["day", "run_id", "batch_id"], "left_semi").select(*schema.fieldNames())
        (merge(rows).withColumn("version", _version_of(versions)).hint("rebalance", "day").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("day", "version").parquet(_data(sink)))
        commit(covers, sink)
    finally:
        covers.unpersist()
    return len(versions)


def commit(covers: DataFrame, sink: str) -> None:
    """Record versions as one file: it is there as a whole or not at all."""
    covers.coalesce(1).write.mode("append").parquet(f"{sink.rstrip('/')}_compacted/commits")


def _version_of(versions: dict[dt.date, int]):
    pairs = F.create_map(*[x for day, v in versions.items() for x in (F.lit(day), F.lit(v))])
    return pairs[F.col("day")].alias("version")


def vacuum(spark: SparkSession, sink: str, schema: StructType) -> int:
    """Remove the folders of covered batches and the copies that newer ones supersede; how many."""
    commits = _commits(spark, sink)
    if commits.isEmpty():
        return 0
    live = read_or_empty(spark, sink, schema).select("day", "run_id", "batch_id").distinct()
    gone = [f"{sink.rstrip('/')}/day={r.day}/run_id={r.run_id}/batch_id={r.batch_id}"
            for r in live.join(_covered(_newest(commits)), ["day", "run_id", "batch_id"], "left_semi").toLocalIterator()]
    copies = read_or_empty(spark, _data(sink), _versioned(schema)).select("day", "version").distinct()
    kept = _newest(commits).select("day", "version")
    gone += [f"{_data(sink)}/day={r.day}/version={r.version}"
             for r in copies.join(kept, ["day", "version"], "left_anti").toLocalIterator()]
    return sum(delete_folder(spark, path) for path in gone)
