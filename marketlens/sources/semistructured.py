"""Load of semi-structured landing records: fields are taken by name and cast, bad records are kept with their reasons.

A record is a JSON object a line.  It is parsed once into a VARIANT; each field of the raw
table is read by its path and cast on its own, so records may drift: fields may be
missing, new ones may come, numbers may be written as text.  A line that is no JSON
object, or a field that is there and doesn't cast, makes the record a rejected one: it
goes, with what is wrong, into the table of rejects, and the load goes on.

``write_loaded`` stores both in one pass, in two folders of one table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.functions.scalar import nanos_to_date
from marketlens.schemas import LANDING_BARS
from marketlens.sources.bars import RAW_COLUMNS

#: Field, type it is cast to.  The bar date is epoch nanoseconds, the ingest time ISO text.
FIELDS = [(f.name, f.dataType.simpleString()) for f in LANDING_BARS.fields]
NO_OBJECT = "no JSON object"
REASONS, REJECTED = "reasons", "rejected"


def _field(record: Column, name: str, as_type: str) -> Column:
    return F.try_variant_get(record, f"$.{name}", as_type)


def parsed(lines: DataFrame) -> DataFrame:
    """Lines (``value``) -> raw columns, the line, and the reasons against it (none: the record loads)."""
    rows = lines.select("value", F.try_parse_json("value").alias("record"))
    record = F.col("record")
    is_object = F.coalesce(F.schema_of_variant(record).startswith("OBJECT"), F.lit(False))
    rows = rows.withColumns({"ok": is_object, **{f"_{n}": F.when(is_object, _field(record, n, t)) for n, t in FIELDS}})
    ingested = F.try_to_timestamp("_ingested_at").cast("timestamp_ntz")
    wrong = [F.when(F.col("ok") & _field(record, n, "string").isNotNull() & F.col(f"_{n}").isNull(), F.lit(f"{n}: no {t}"))
             for n, t in FIELDS]
    wrong += [F.when(F.col("_ingested_at").isNotNull() & ingested.isNull(), F.lit("ingested_at: no timestamp")),
              F.when(~F.col("ok"), F.lit(NO_OBJECT))]
    typed = {"date": nanos_to_date("_date"), "ingested_at": ingested}
    return rows.select(*[typed.get(c, F.col(f"_{c}")).alias(c) for c in RAW_COLUMNS], "value",
                       F.array_compact(F.array(*wrong)).alias(REASONS))


def write_loaded(lines: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Store the records of ``lines``; (raw bars, rejected lines with their reasons), read from their folders."""
    rows = parsed(lines).withColumn(REJECTED, F.size(REASONS) > 0)
    line = F.when(F.col(REJECTED), F.col("value"))             # a loaded line is its columns
    rows.withColumn("value", line).write.mode("overwrite").partitionBy(REJECTED).parquet(path)
    stored = lines.sparkSession.read.schema(rows.schema).parquet(path)
    return (stored.filter(~F.col(REJECTED)).select(*RAW_COLUMNS),
            stored.filter(REJECTED).select("value", REASONS))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """All JSON-lines files below ``path``."""
    return spark.read.option("recursiveFileLookup", "true").text(path)
