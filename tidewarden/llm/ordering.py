"""Running counts over sorted rows and counts of keys, without a single hot task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settled

RUNS = 256


def running_totals(
    rows: DataFrame, keys: list[str], totals: dict[str, str], keep: list[str], label: str
) -> DataFrame:
    """The columns ``keep`` of ``rows`` with the sums of integer columns (``totals``: column to name of its sum) over
    all rows up to and including this one in the order of ``keys``.

    Rows are sorted by range, summed inside each partition, and shifted by the sums of the
    partitions before. Only one row per partition is gathered.
    """
    used = dict.fromkeys([*keys, *totals, *keep])
    plain = rows.select(*used).withColumns({name: F.lit(0).cast("long") for name in totals.values()})
    plain = plain.withColumn("_part", F.lit(0))
    names = plain.columns

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends = dict.fromkeys(totals, 0)
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = list(batch.columns)
            for step, name in totals.items():
                sums = np.cumsum(columns[names.index(step)].to_numpy(zero_copy_only=False)).astype(np.int64) + ends[step]
                ends[step] = int(sums[-1])
                columns[names.index(name)] = pa.array(sums)
            yield pa.RecordBatch.from_arrays([columns[names.index(n)] for n in kept], names=kept)

    kept = [*keep, *totals.values(), "_part"]
    ordered = plain.orderBy(*keys).withColumn("_part", F.spark_partition_id())
    written = settled(ordered.mapInArrow(add_up, ordered.select(*kept).schema), label)
    parts = written.groupBy("_part").agg(*[F.max(n).alias(n) for n in totals.values()]).orderBy("_part").collect()
    before, shifts = [0] * len(totals), []
    for part in parts:
        shifts.append((part["_part"], *before))
        before = [b + part[n] for b, n in zip(before, totals.values(), strict=True)]
    moved = [f"_shift_{n}" for n in totals.values()]
    schema = "_part int, " + ", ".join(f"`{m}` long" for m in moved)
    table = written.sparkSession.createDataFrame(shifts, schema)
    shifted = written.join(F.broadcast(table), "_part")  # one row per partition
    return shifted.withColumns({n: F.col(n) + F.col(m) for n, m in zip(totals.values(), moved, strict=True)}).drop("_part", *moved)


def repeated_rows(rows: DataFrame, keys: list[str], spread: Column, weight: Column | None = None) -> DataFrame:
    """The rows whose key has a total weight of at least 2 over all rows.

    A hash of ``spread`` gives each row's run. One aggregation has a key's weight and, as bits, the runs that it is
    found in; rows get their answer by key and run, so the rows of one key are dealt over all runs.
    """
    marked = rows.withColumn("_run", F.pmod(F.xxhash64(spread), F.lit(RUNS)).cast("int"))
    one = F.lit(1) if weight is None else weight
    words = range(RUNS // 64)
    found = [F.bit_or(F.expr(f"CASE WHEN _run DIV 64 = {i} THEN shiftleft(1L, _run % 64) ELSE 0L END")).alias(f"_runs_{i}") for i in words]
    counted = marked.groupBy(*keys).agg(F.sum(one).alias("_n"), F.min("_run").alias("_low"), F.max("_run").alias("_high"), *found)
    few = " + ".join(f"bit_count(_runs_{i})" for i in words) + " <= 2"
    many = ", ".join(f"filter(sequence({64 * i}, {64 * i + 63}), r -> shiftright(_runs_{i}, r % 64) & 1 = 1)" for i in words)
    runs = F.expr(f"CASE WHEN {few} THEN array_distinct(array(_low, _high)) ELSE concat({many}) END")
    often = counted.where("_n > 1").select(*keys, F.explode(runs).alias("_run"))
    return marked.join(often, [*keys, "_run"]).drop("_run")
