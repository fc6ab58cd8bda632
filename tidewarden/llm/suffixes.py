"""Distributed difference-cover suffix sorting of many strings.

A string is a row (sid, symbols): 64-bit symbols, 0 for a gap at which comparisons end.
Positions 1 and 2 modulo 3 are sampled. Their triples of symbols are sorted and named by
the rank of the distinct ones. The names of each sampled residue form a new string, which
is ranked in the same way; as a name stands for three symbols, the recursion ends when
names cover ``depth`` symbols or no name occurs twice. The remaining suffixes, 0 modulo
3, are their first symbol and a sampled suffix. They are merged in by counting: among
residue 1 they compare by (symbol, next rank), among residue 2 by (symbol, symbol,
next rank), and a suffix's rank is the number of smaller ones in all three residues.

Every sort is a range sort of rows with running counts; a string is never longer
than a document, and no group of equal suffixes is gathered anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settled
from .ordering import running_totals

TRIPLE = ["s0", "s1", "s2"]


def _triples(symbols: np.ndarray) -> np.ndarray:
    """The three symbols from every position; whatever follows a gap is a gap."""
    padded = np.concatenate((symbols, np.zeros(2, np.int64)))
    out = np.stack([padded[k : k + len(symbols)] for k in range(3)], axis=1)
    out[out[:, 0] == 0] = 0
    out[out[:, 1] == 0, 2] = 0
    return out


def _lists(column: pa.Array) -> Iterator[np.ndarray]:
    values, offsets = column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    for a, b in zip(offsets[:-1] - offsets[0], offsets[1:] - offsets[0], strict=True):
        yield values[a:b]


def _emit(columns: dict[str, list[np.ndarray]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(c) if c else np.zeros(0, np.int64)) for c in columns.values()], names=list(columns)
    )


def _positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """sid, j and triple of every position that is not a gap."""
    for batch in batches:
        out: dict[str, list] = {n: [] for n in ("sid", "j", *TRIPLE)}
        for sid, symbols in zip(batch.column("sid").to_numpy(), _lists(batch.column("symbols")), strict=True):
            j = np.flatnonzero(symbols)
            found = _triples(symbols)[j]
            for name, value in zip(out, (np.full(len(j), sid), j, *found.T), strict=True):
                out[name].append(value.astype(np.int64))
        yield _emit(out)


def _named(rows: DataFrame) -> tuple[DataFrame, bool]:
    """``rows`` (with a triple) and the rank of the triple among the distinct ones; whether
    every triple occurs once."""
    counted = rows.groupBy(*TRIPLE).agg(F.count(F.lit(1)).alias("n")).withColumn("one", F.lit(1))
    names = running_totals(counted, TRIPLE, {"one": "name"}, [*TRIPLE, "n"], "suffix-names")
    unique = names.where("n > 1").isEmpty()
    named = rows.join(names.select(*TRIPLE, "name"), TRIPLE)
    return named.select("sid", "j", "name", (F.col("s2") != 0).cast("int").alias("open")), unique


def _next_strings(named: DataFrame) -> DataFrame:
    """Strings of names, one per string and sampled residue; sid is 2 * old sid + residue - 1.

    ``at`` keeps the old positions. A name whose triple has a gap ends its run.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, symbols, places = [], [], []
            columns = zip(batch.column("sid").to_pylist(), batch.column("found").to_pylist(), strict=True)
            for sid, found in columns:
                for residue in (1, 2):
                    names, at, before = [], [], None
                    for entry in sorted((e for e in found if e["j"] % 3 == residue), key=lambda e: e["j"]):
                        if before is not None and (entry["j"] != before["j"] + 3 or before["open"] == 0):
                            names.append(0)
                            at.append(-1)
                        names.append(entry["name"])
                        at.append(entry["j"])
                        before = entry
                    if names:
                        ids.append(2 * sid + residue - 1)
                        symbols.append(names)
                        places.append(at)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(symbols, pa.list_(pa.int64())), pa.array(places, pa.list_(pa.int64()))],
                names=["sid", "symbols", "at"],
            )

    grouped = named.groupBy("sid").agg(
        F.collect_list(F.struct("j", "name", "open")).alias("found")
    )
    return settled(grouped.mapInArrow(build, "sid long, symbols array<long>, at array<long>"), "suffix-strings")


def _merged(positions: DataFrame, ranks: DataFrame) -> DataFrame:
    """Ranks of all positions from those of the sampled ones."""
    sampled = ranks.withColumn("residue", F.col("j") % 3)

    def after(offset: int) -> DataFrame:
        return sampled.select("sid", (F.col("j") - offset).alias("j"), F.col("rank").alias(f"r{offset}"))

    base = positions.select("sid", "j", "s0", "s1", (F.col("j") % 3).alias("residue"))
    nexts = base.join(after(1), ["sid", "j"], "left").join(after(2), ["sid", "j"], "left")
    nexts = settled(
        nexts.select(
            "sid", "j", "residue", "s0", "s1",
            F.when(F.col("s1") != 0, F.coalesce("r1", F.lit(0))).otherwise(0).alias("r1"),
            F.when(F.col("s1") != 0, F.coalesce("r2", F.lit(0))).otherwise(0).alias("r2"),
        ),
        "suffix-nexts",
    )
    is_rest = (F.col("residue") == 0).cast("int")
    own = running_totals(sampled.withColumn("one", F.lit(1)), ["rank", "sid", "j"], {"one": "own"}, ["sid", "j"], "suffix-own")

    def counted(other: int, keys: list[str]) -> DataFrame:
        both = nexts.where(F.col("residue").isin(0, other)).withColumns({"rest": is_rest, "other": 1 - is_rest})
        sums = {"rest": f"rests_{other}", "other": f"others_{other}"}
        return running_totals(both, [*keys, "sid", "j"], sums, ["sid", "j", "rest"], "suffix-merge")

    with_1, with_2 = counted(1, ["s0", "r1"]), counted(2, ["s0", "s1", "r2"])
    rest = with_1.where("rest = 1").join(with_2.where("rest = 1").select("sid", "j", "others_2"), ["sid", "j"])
    rest = rest.select("sid", "j", (F.col("rests_1") + F.col("others_1") + F.col("others_2")).alias("rank"))
    first = with_1.where("rest = 0").join(own, ["sid", "j"])
    second = with_2.where("rest = 0").join(own, ["sid", "j"])
    return (
        rest.union(first.select("sid", "j", (F.col("own") + F.col("rests_1")).alias("rank")))
        .union(second.select("sid", "j", (F.col("own") + F.col("rests_2")).alias("rank")))
    )


def suffix_ranks(strings: DataFrame, depth: int) -> DataFrame:
    """sid, j and rank of every position that is not a gap.

    The order is that of the suffixes up to the next gap, exact for as long as they
    differ within ``depth`` symbols; equal ones are ordered by string and position.
    """
    positions = settled(strings.select("sid", "symbols").mapInArrow(_positions, "sid long, j long, s0 long, s1 long, s2 long"), "suffix-positions")
    return _ranked(positions, depth, 3)


def _ranked(positions: DataFrame, depth: int, covered: int) -> DataFrame:
    named, unique = _named(positions.where("j % 3 <> 0"))
    if unique or covered >= depth:
        ranks = named.select("sid", "j", F.col("name").alias("rank"))
    else:
        named = settled(named, "suffix-named")
        strings = _next_strings(named)
        inner = strings.mapInArrow(_positions, "sid long, j long, s0 long, s1 long, s2 long")
        places = strings.select("sid", F.posexplode("at").alias("j", "old")).where("old >= 0")
        ranks = (
            _ranked(settled(inner, "suffix-positions"), depth, covered * 3)
            .join(places.withColumn("j", F.col("j").cast("long")), ["sid", "j"])
            .select(F.shiftright("sid", 1).alias("sid"), F.col("old").alias("j"), "rank")
        )
    return settled(_merged(positions, settled(ranks, "suffix-ranks")), "suffix-all")
