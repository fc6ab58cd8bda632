"""Joins that stay balanced when one key holds most rows.

The row count of a group is known before its rows are shuffled: it comes from an
aggregation that combines on the map side. The largest groups, one per shuffle
partition, are a list of fixed length and may therefore be broadcast; their rows
are cut into slices by hash. Every other group holds at most 1/partitions of all
rows and uses a plain equi-join, which AQE turns into a broadcast where the real
size allows it.

Key columns should be declared non-null (``functions.text.never_null``): otherwise
the optimizer adds null filters on one side of a join only, and an aggregation
used twice is no longer recognised as the same and runs twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shuffle_partitions

SLICE_ROWS = 1_000_000


def heaviest_groups(groups: DataFrame, weight: str) -> DataFrame:
    """The largest groups, as many as there are shuffle partitions, whatever the data."""
    return groups.orderBy(F.desc(weight)).limit(shuffle_partitions(groups.sparkSession))


def slice_of(spread_on: list[str], slices: Column) -> Column:
    """Slice number of a row. The partition number parts copies of one row as well,
    and unlike a random number it is the same when a lost task runs again."""
    return F.pmod(F.xxhash64(F.spark_partition_id(), *spread_on), slices).cast("int")


def join_groups(
    rows: DataFrame,
    groups: DataFrame,
    keys: list[str],
    weight: str,
    spread_on: list[str],
    keep: Column | None = None,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Attach one row per group to its members without a hot task.

    ``groups`` must hold every group present in ``rows`` so that hot groups are
    recognised; ``keep`` then selects the groups wanted in the result, and rows
    of unwanted hot groups are dropped before any shuffle. ``spread_on`` names
    columns that differ between the rows of one group. Groups above ``slice_rows``
    rows are cut into slices of about that size.
    """
    wanted = F.lit(True) if keep is None else F.coalesce(keep, F.lit(False))
    most = 4 * shuffle_partitions(rows.sparkSession)
    slices = F.least(F.ceil(F.col(weight) / F.lit(slice_rows)), F.lit(most)).cast("int")
    marked = groups.withColumn("_slices", slices).withColumn("_wanted", wanted)
    hot = heaviest_groups(marked, weight).where("_slices > 1").select(*keys, "_slices", "_wanted")
    tagged = (
        rows.join(F.broadcast(hot), keys, "left")
        .where(F.coalesce(F.col("_wanted"), F.lit(True)))
        .withColumn("_slice", F.coalesce(slice_of(spread_on, F.col("_slices")), F.lit(0)))
        .drop("_slices", "_wanted")
    )
    copied = (
        marked.where("_wanted")
        .withColumn("_slice", F.explode(F.sequence(F.lit(0), F.col("_slices") - 1)))
        .drop("_slices", "_wanted")
    )
    return tagged.join(copied, [*keys, "_slice"]).drop("_slice")


def small_group_rows(
    rows: DataFrame, sizes: DataFrame, keys: list[str], weight: str, limit: int
) -> DataFrame:
    """Rows of the groups with at most ``limit`` members.

    The heaviest groups leave through a bounded broadcast first, so that the
    second exclusion never funnels one of them into a single task.
    """
    over = F.col(weight) > F.lit(limit)
    hottest = heaviest_groups(sizes, weight).where(over).select(*keys)
    large = sizes.where(over).select(*keys)
    return _without(_without(rows, F.broadcast(hottest), keys), large, keys)


def _without(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of other groups. An anti join would be moved below an aggregation in
    ``rows``, which would then be computed once more; an outer join stays in place."""
    marked = groups.withColumn("_listed", F.lit(True))
    return rows.join(marked, keys, "left").where(F.col("_listed").isNull()).drop("_listed")
