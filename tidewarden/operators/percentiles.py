"""Exact continuous percentiles that never hold a whole large group.

The input is first reduced to distinct values with their counts, which combines
on the map side and spreads a hot group over all tasks. Groups with few distinct
values then use Spark's ``percentile`` with frequencies (its buffer is bounded by
the number of distinct values). For larger groups the wanted ranks are located by
counting:

1. count values per logarithmic bin and find the bins that hold a wanted rank;
2. cut those bins into equal parts between their own minimum and maximum;
3. order the distinct values of the parts that still hold more than one value.

Only counts are ordered within a group, and a part of step 2 spans at most a few
million representable doubles, so each step's per-group size is bounded whatever
the row count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.skew import small_group_rows

INLINE_VALUES = 200_000
_LOG_STEPS = 4096  # bins per factor e
_LOG_SHIFT = 746 * _LOG_STEPS  # ln of the smallest positive double is about -745
_PARTS = 1 << 20
_OUTER = 1 << 40


def _log_bin(value: Column) -> Column:
    """Monotone bin number: negative values mirrored below zero, non-finite ones outermost."""
    size = F.floor(F.ln(F.abs(value)) * _LOG_STEPS) + _LOG_SHIFT
    return (
        F.when(F.isnan(value), F.lit(2 * _OUTER))
        .when(value == float("inf"), F.lit(_OUTER))
        .when(value == float("-inf"), F.lit(-_OUTER))
        .when(value == 0, F.lit(0))
        .otherwise(F.signum(value) * size)
        .cast("bigint")
    )


def _ranks(total: Column, probabilities: list[float]) -> Column:
    """The zero-based ranks next to each percentile position."""
    wanted = []
    for p in probabilities:
        position = F.lit(p) * (total - 1)
        wanted += [F.floor(position), F.ceil(position)]
    return F.array_distinct(F.array(*[w.cast("bigint") for w in wanted]))


def _locate(counted: DataFrame, within: list[str], order: str) -> DataFrame:
    """Keep the pieces that hold a wanted rank, with the number of rows before each.

    ``counted`` carries ``base`` (rows before the enclosing piece) and ``ranks``.
    """
    running = Window.partitionBy(*within).orderBy(order)
    before = F.col("base") + F.sum("n").over(running.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    placed = counted.withColumn("before", before)
    hit = F.filter(
        "ranks", lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("n"))
    )
    return placed.withColumn("ranks", hit).where(F.size("ranks") > 0)


def _large_group_percentiles(
    values: DataFrame, keys: list[str], probabilities: list[float], name: str
) -> DataFrame:
    """Rank search in ``values`` (keys, total, value, n); one pass per step.

    The pieces joined back are a handful per group, so these joins are left to
    AQE: a broadcast while the pieces are few, else a join with skew splitting.
    """
    binned = values.withColumn("bin", _log_bin(F.col("value")))
    extent = [F.sum("n").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")]
    group = [*keys, "total"]
    level1 = (
        binned.groupBy(*group, "bin").agg(*extent)
        .withColumn("ranks", _ranks(F.col("total"), probabilities))
        .withColumn("base", F.lit(0).cast("bigint"))
    )
    bins = _locate(level1, group, "bin").select(
        *group, "bin", "low", "high", "ranks", F.col("before").alias("base")
    )

    at = [*group, "bin"]
    share = (F.col("value") - F.col("low")) / (F.col("high") - F.col("low"))
    part = F.when(F.col("low") == F.col("high"), F.lit(0)).otherwise(
        F.least(F.floor(share * _PARTS), F.lit(_PARTS - 1))
    )
    level2 = (
        binned.join(bins, at)
        .withColumn("part", part)
        .groupBy(*at, "part", "base", "ranks").agg(*extent)
    )
    spans = (
        _locate(level2, at, "part")
        .groupBy(*at)
        .agg(
            F.collect_list(
                F.struct("part", "low", "high", F.col("before").alias("base"), "ranks")
            ).alias("spans")
        )
    )
    inside = F.filter("spans", lambda s: F.col("value").between(s["low"], s["high"]))
    level3 = (
        binned.join(spans, at)
        .select(*at, "value", "n", F.explode(inside).alias("span"))
        .select(*at, "value", "n", "span.part", "span.base", "span.ranks")
    )
    found = _locate(level3, [*at, "part"], "value").select(
        *group, F.explode("ranks").alias("rank"), F.col("value").alias("found")
    )
    by_rank = found.groupBy(*group).agg(
        F.map_from_entries(F.collect_list(F.struct("rank", "found"))).alias("at_rank")
    )
    out = []
    for p in probabilities:
        position = F.lit(p) * (F.col("total") - 1)
        below, above = F.floor(position), F.ceil(position)
        low = F.try_element_at("at_rank", below.cast("bigint"))
        high = F.try_element_at("at_rank", above.cast("bigint"))
        # the formula of the built-in function, so that a group's size does not show in the last bits
        between = low * (above - position) + high * (position - below)
        out.append(F.when(low == high, low).otherwise(between))
    return by_rank.select(*keys, F.array(*out).alias(name))


def distinct_values(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys, ``value`` and the number of rows ``n`` that hold it (null included)."""
    return rows.groupBy(*keys, F.col(value).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def value_rows() -> Column:
    """Rows of a distinct value that take part in percentiles: none for null."""
    return F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)


def value_counts() -> list[Column]:
    """Aggregates over distinct values: non-null rows and distinct non-null values.

    Both read ``value`` and ``n``, so the distinct values are planned alike wherever
    they are used and are computed once.
    """
    rows = value_rows()
    return [F.sum(rows).alias("n"), F.count_if(rows > 0).alias("distinct")]


def exact_percentiles(
    values: DataFrame,
    groups: DataFrame,
    keys: list[str],
    probabilities: list[float],
    name: str = "percentiles",
    inline_values: int = INLINE_VALUES,
) -> DataFrame:
    """Keys and an array of interpolated percentiles.

    ``values`` comes from :func:`distinct_values`; ``groups`` holds per key the two
    numbers of :func:`value_counts`. Groups without any value are left out or null.
    """
    sizes = groups.select(*keys, "n", "distinct")
    wanted = F.array(*[F.lit(p) for p in probabilities])
    small = (
        small_group_rows(values, sizes, keys, "distinct", inline_values)
        .groupBy(*keys)
        .agg(F.percentile("value", wanted, F.col("n")).alias(name))
    )
    big = sizes.where(F.col("distinct") > inline_values)
    large_values = values.withColumn("n", value_rows()).join(
        big.select(*keys, F.col("n").alias("total")), keys
    )
    large = _large_group_percentiles(large_values, keys, probabilities, name)
    return small.unionByName(large)
