"""Positions of rows within their group, in order, for groups of any size.

Rows are range-partitioned by key and order, so a large group lies in several neighbouring
partitions. What is written to the shared folder is each row with the number of its partition and
its place in it; all the rest follows from aggregates of those two numbers: the rows of a
group in earlier partitions (one small row per group and partition) plus the place behind the group's first row.
No task ever holds a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written_once

#: Generated row numbers hold the partition above these bits.
_PLACE_BITS = 33


def with_positions(rows: DataFrame, keys: list[str], order: list[Column | str], partitions: int | None = None) -> DataFrame:
    """Add ``position``, from 0, within the rows of equal ``keys``, which must not be null, by rising ``order``.

    Rows equal in keys and order share a task and come in any order; reduce them to counts before.
    """
    names = [f"_by{i}" for i in range(len(order))]
    given = rows.withColumns({n: F.col(o) if isinstance(o, str) else o for n, o in zip(names, order, strict=True)})
    by = [*keys, *names]
    ranged = given.repartitionByRange(*by) if partitions is None else given.repartitionByRange(partitions, *by)
    number = F.monotonically_increasing_id()
    numbered = ranged.sortWithinPartitions(*by).drop(*names).withColumns(
        {"_part": F.shiftright(number, _PLACE_BITS), "_place": number.bitwiseAND((1 << _PLACE_BITS) - 1)}
    )
    placed = written_once(numbered, "positions")
    parts = placed.groupBy(*keys, "_part").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # a group has one row here for each partition that it reaches into
    starts = parts.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0))).drop("_rows")
    found = placed.join(starts, [*keys, "_part"])
    return found.withColumn("position", F.col("_place") - F.col("_first") + F.col("_before")).drop(
        "_part", "_place", "_first", "_before"
    )
