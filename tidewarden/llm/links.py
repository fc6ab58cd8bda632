"""Connected components of a link table, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settled


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node and component (its smallest reachable node) of every node in ``links`` (a, b).

    Alternates two contractions until nothing changes: every node links its larger
    neighbours to its smallest one, then its smaller neighbours to it. The number
    of links never grows, stars form in a logarithmic number of rounds, and each
    round is written to the shared folder, so no plan or lineage grows. Hot nodes
    only take part in map-side combined minima and joins that AQE can split.
    """
    both = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = settled(both.where("a > b").distinct(), "links")
    for _ in range(most_rounds):
        last = _signature(edges)
        edges = settled(_small_star(_large_star(edges)), "links")
        if _signature(edges) == last:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def _signature(edges: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), total).first())


def _large_star(edges: DataFrame) -> DataFrame:
    around = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
    least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    moved = around.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.where("a <> b")  # repeated links do no harm and go with the small stars


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    kept = least.select("a", F.col("m").alias("b"))
    return moved.union(kept).where("a <> b").distinct()
