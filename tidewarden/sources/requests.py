"""Batches of ingest requests and their receipts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import EVENT_REQUEST


def read_request_arrays(spark: SparkSession, path: str, schema: T.StructType = EVENT_REQUEST) -> DataFrame:
    """Requests from files that each hold a JSON array."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def explode_requests(
    bodies: DataFrame, column: str = "body", schema: T.StructType = EVENT_REQUEST
) -> DataFrame:
    """Requests from a column of JSON array text; other columns are kept."""
    others = [c for c in bodies.columns if c != column]
    items = F.from_json(column, T.ArrayType(schema))
    return bodies.select(*others, F.explode(items).alias("item")).select(*others, "item.*")


def batch_receipts(events: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Per batch the number of events; their ids are the rows of :func:`receipt_ids`."""
    return events.groupBy(batch).agg(F.count(F.lit(1)).alias("count"))


def receipt_ids(events: DataFrame, batch: str = "batch_id") -> DataFrame:
    """The ids of every batch as rows, with the number of events that carry each."""
    return events.where(F.col("id").isNotNull()).groupBy(batch, "id").agg(F.count(F.lit(1)).alias("copies"))
