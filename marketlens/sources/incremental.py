"""Load once: landing files go into the stored raw table the first time a load sees them.

The table owns its load history: the checkpoint of a file stream under ``_load``, which
lists every landing file that a load has taken up.  A load runs the stream once over
what is new (``availableNow``) and ends; files of earlier loads are not opened.  A
micro-batch writes the folders ``year=<bar year>/batch_id=<batch>``, so a batch that is
repeated after a failure replaces its own rows and nothing else.  Bar years in the
layout let what follows a load read only the years that it touched.

A landing file is known by its path: a file written anew under another name (a rerun of
a run date) is a new file, and ``dedup_latest`` keeps the newest load of each bar.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, LongType, StringType, StructType

from marketlens.schemas import LANDING_BARS, RAW_BARS
from marketlens.sources.bars import RAW_COLUMNS, load_raw_columns
from marketlens.sources.tables import read_or_empty
from marketlens.streaming.alerts_stream import run_to_end

#: The stored raw table: raw bars, their run date and file, and the layout columns.
RAW_TABLE = (StructType([*RAW_BARS.fields]).add("dt", DateType()).add("file", StringType())
             .add("year", IntegerType()).add("batch_id", LongType()))
#: Files older than this, measured from the newest file seen, leave the load history and count as loaded.
HISTORY = "3650d"


def new_files(spark: SparkSession, landing: str, files_per_batch: int | None = None) -> DataFrame:
    """The landing area as a stream of rows, each with its run date and file."""
    reader = (spark.readStream.schema(StructType([*LANDING_BARS.fields]).add("dt", DateType()))
              .option("pathGlobFilter", "*.parquet").option("maxFileAge", HISTORY))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    return reader.parquet(landing).select("*", F.col("_metadata.file_path").alias("file"))


def batch_writer(table: str):
    """``foreachBatch`` callback: one batch's rows into the folders of that batch."""
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = load_raw_columns(batch, "file").withColumnRenamed("_dt", "dt")
        (rows.withColumns({"year": F.year("date"), "batch_id": F.lit(batch_id).cast("long")})
         .hint("rebalance", "year").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("year", "batch_id").parquet(table))

    return write


def load_new_files(spark: SparkSession, landing: str, table: str, files_per_batch: int | None = None) -> int:
    """Load the landing files that no earlier load of ``table`` took up; the number of rows loaded."""
    query = (new_files(spark, landing, files_per_batch).writeStream.foreachBatch(batch_writer(table))
             .option("checkpointLocation", f"{table.rstrip('/')}/_load").trigger(availableNow=True).start())
    run_to_end(query)
    return sum(p["numInputRows"] for p in query.recentProgress)


def read_raw_table(spark: SparkSession, table: str) -> DataFrame:
    return read_or_empty(spark, table, RAW_TABLE)


def raw_bars(table_rows: DataFrame) -> DataFrame:
    return table_rows.select(*RAW_COLUMNS)


def load_history(table_rows: DataFrame) -> DataFrame:
    """What each batch loaded: files, rows, first and last bar date, by run date."""
    return table_rows.groupBy("batch_id", "dt").agg(
        F.count_distinct("file").alias("n_files"), F.count(F.lit(1)).alias("n_rows"),
        F.min("date").alias("min_date"), F.max("date").alias("max_date"))
