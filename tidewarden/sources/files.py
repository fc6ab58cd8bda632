"""Reading tables that may not exist yet, and removing folders of any file system Spark reaches."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The Parquet rows below ``path``; none where nothing has been written yet."""
    try:
        rows = spark.read.schema(schema).parquet(path)
        rows.schema  # resolves the path
        return rows
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
