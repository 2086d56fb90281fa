"""Stored tables: reading them before they exist, removing folders that nothing reads any more."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A stored table under its schema; without rows where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Remove a folder of a stored table through the file system that holds it."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
