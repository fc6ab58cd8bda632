"""Integer forms of embedding rows, shared by the operators on vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: a component c becomes floor(SCALE * c).
SCALE = 256
#: Components at or beyond this size leave no room for exact sums and count as non-finite.
LARGEST = float(1 << 32)


def usable(vector: Column) -> Column:
    """True for a vector with components, all of them finite numbers below ``LARGEST``."""
    good = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(LARGEST), F.lit(False)))
    return F.coalesce(good & (F.size(vector) > 0), F.lit(False))


def integers(vector: Column) -> Column:
    """floor(SCALE * c) of every component, computed in double."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(SCALE))).cast("long"))


def of_common_length(rows: DataFrame, vector: str = "x") -> tuple[DataFrame, int]:
    """The rows whose vector has the most frequent length (of equally frequent ones the
    longest), and that length; 0 for an empty table."""
    lengths = rows.groupBy(F.size(vector).alias("d")).agg(F.count(F.lit(1)).alias("n"))
    first = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    if first is None:
        return rows, 0
    return rows.where(F.size(vector) == first.d), first.d
