"""Sums of doubles that do not depend on the order of the rows, as plain aggregates.

A double is a whole number of 93 bits at most times a power of two that depends on its bin of
forty binary exponents. The whole number is cut into three parts of 31 bits, and the parts are added up as
longs per group and bin: integer sums are exact and the same for every partitioning. A group then has one
row per bin, few for real data, and never more than ``BINS``; they are put together in a fixed order
with a second number for what is lost to rounding.

Exact for groups of up to 2**31 rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Binary exponents per bin, bits per part, of a double's mantissa, and of half a long.
BIN, PART, MANTISSA, HALF = 40, 31, 52, 32
BINS = 54
_PARTS = ["_p2", "_p1", "_p0"]


def _power(exponent: Column) -> Column:
    """2.0 to a whole exponent between -1074 and 1023, in two exact steps."""
    half = F.floor(exponent / 2)
    return F.pow(F.lit(2.0), half.cast("double")) * F.pow(F.lit(2.0), (exponent - half).cast("double"))


def _scaled(value: Column, exponent: Column) -> Column:
    """value * 2**exponent in steps that neither overflow nor lose a bit."""
    first = F.greatest(F.least(exponent, F.lit(1000)), F.lit(-1000))
    return value * _power(first) * _power(exponent - first)


def _bin(value: Column) -> Column:
    """Bin of a finite value; zero counts with the smallest numbers. Any function of the value will do,
    as long as the value is whole after scaling: a logarithm that rounds up at a bin's end is put right."""
    size = F.abs(value)
    guess = F.floor(F.log2(F.when(size > 0, size)) / BIN).cast("int")
    lower = F.when(size < _power(guess * BIN), guess - 1).otherwise(guess)
    return F.greatest(F.coalesce(lower, F.lit(-27)), F.lit(-27))


def _parts(value: Column, place: Column) -> list[Column]:
    """Parts of the whole number value * 2**(52 - 40 * bin), all with the value's sign."""
    sign = F.when(value < 0, F.lit(-1)).otherwise(F.lit(1)).cast("long")
    whole = _scaled(F.abs(value), F.lit(MANTISSA) - place * BIN)
    high = F.floor(whole * 2.0 ** (-2 * PART))
    rest = whole - high.cast("double") * 2.0 ** (2 * PART)
    middle = F.floor(rest * 2.0**-PART)
    low = rest - middle.cast("double") * 2.0**PART
    return [sign * part.cast("long") for part in (high, middle, low)]


def exact_sums(rows: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """``name``: the sum of the finite values of every group, 0.0 where there is none.

    Null values and values that are not finite are left out.
    """
    v = F.col(value).cast("double")
    finite = rows.where(v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    placed = finite.select(*keys, v.alias("_v"), _bin(v).alias("_bin"))
    parts = placed.select(*keys, "_bin", *[p.alias(n) for n, p in zip(_PARTS, _parts(F.col("_v"), F.col("_bin")), strict=True)])
    sums = parts.groupBy(*keys, "_bin").agg(*[F.sum(n).alias(n) for n in _PARTS])
    # halves of the part sums, as doubles exact, from the highest down
    terms = [
        _scaled(half.cast("double"), F.col("_bin") * BIN + (shift - MANTISSA))
        for n, low in zip(_PARTS, (2 * PART, PART, 0), strict=True)
        for half, shift in ((F.shiftright(n, HALF), low + HALF), (F.col(n).bitwiseAND(F.lit((1 << HALF) - 1)), low))
    ]
    bins = sums.select(*keys, F.struct((-F.col("_bin")).alias("order"), F.array(*terms).alias("v")).alias("_of_bin"))
    listed = F.flatten(F.transform(F.array_sort(F.collect_list("_of_bin")), lambda b: b["v"]))
    return bins.groupBy(*keys).agg(F.aggregate(listed, _pair(F.lit(0.0), F.lit(0.0)), _added, lambda t: t["sum"] + t["lost"]).alias(name))


def _pair(total: Column, lost: Column) -> Column:
    return F.struct(total.alias("sum"), lost.alias("lost"))


def _added(total: Column, x: Column) -> Column:
    """A sum and what its roundings have lost."""
    s = total["sum"]
    fresh = s + x
    lost = F.when(F.abs(s) >= F.abs(x), (s - fresh) + x).otherwise((x - fresh) + s)
    return _pair(fresh, total["lost"] + lost)
