"""Near-duplicate documents by HyperMinHash.

Sketch: the shingle hashes of a document are dealt to buckets by one part of the
hash; a register keeps the smallest other part of its bucket, compressed to its
leading-zero count and the mantissa bits that follow. Registers are banded; a band
whose registers are all empty gives no key.

Candidates: documents with the same set of shingles are one class first, so copies
never meet each other. In the group of classes that share a band key every class
meets two members only, those with the smallest and the largest hash of their id;
groups hold different classes and draw one of ``DRAWS`` hashes, so a pair that shares
several bands meets directly or through common partners.

Rest: this may miss links between classes that are no hubs. In every band group that
still holds several components, all pairs across components are compared: the classes
outside the group's largest component with all others, in tiles of bounded size, every pair in
the first band that it shares. This step grows with the product of both sides; it
ends with no pair that shares a band left open.

A candidate pair must pass the Jaccard estimate from the registers, corrected for
the chance that unlike sets have equal compressed registers and lowered by
``SLACK`` standard errors, and is then confirmed on the full shingle sets. Pairs
within one component are not looked at again.

With 40 bands of 4 registers a pair at similarity 0.75 shares no band with
probability (1 - 0.75**4) ** 40 = 2.5e-7.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bytescan as B
from .common import packed, settled
from .links import components
from .membership import bitmap_of, held_rows

WIDTH = 5
SIMILAR = (75, 100)
BANDS, BAND_REGISTERS = 40, 4
REGISTERS = BANDS * BAND_REGISTERS
MANTISSA_BITS = 10
SLACK = 4.5
DRAWS = 8
TILE = 1024
TILE_SHINGLES = 1 << 20
CROWD = 32
RUNS = 64
#: Text looked at in one go; scans take some fifty bytes of memory for each.
SLICE_BYTES = 1 << 19
DIGEST_SALTS = (np.uint64(0x5BD1E995D1B54A32), np.uint64(0xC2B2AE3D27D4EB4F))
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingles(content: np.ndarray, bounds: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted within each row, and the offset of each row's part.

    A row with fewer words than ``width`` has its whole word sequence as one shingle.
    """
    content = B.TO_LOWER[content]
    starts, ends, rows = B.word_bounds(content, bounds)
    words = B.word_hashes(content, starts, ends)
    found, owner = B.windows_of(words, rows, width)
    counts = np.bincount(rows, minlength=len(bounds) - 1)
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        first = np.concatenate(([0], np.cumsum(counts)))[short]
        extra = np.zeros(len(short), np.uint64)
        for k in range(width - 1):
            has = counts[short] > k
            extra[has] = extra[has] * np.uint64(0x2545F4914F6CDD1D) + words[first[has] + k]
        extra = B.mixed(extra ^ (counts[short].astype(np.uint64) * B.MULTIPLIER))
        found, owner = np.concatenate((found, extra)), np.concatenate((owner, short))
        order = np.argsort(owner, kind="stable")
        found, owner = found[order], owner[order]
    cuts = np.searchsorted(owner, np.arange(len(bounds)))
    parts = [np.unique(found[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int64)
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64), offsets


def registers(found: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of compressed registers per document; 65535 marks an empty bucket."""
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    table = np.full((len(offsets) - 1) * REGISTERS, _EMPTY, np.uint64)
    bucket = (found % np.uint64(REGISTERS)).astype(np.int64)
    np.minimum.at(table, rows * REGISTERS + bucket, B.mixed(found ^ np.uint64(0xA5A5A5A5A5A5A5A5)) >> np.uint64(1))
    # a value below 2**63 is exact in its leading bits as a float of twice the width of a mantissa
    value = np.maximum(table, np.uint64(1))
    top = np.frexp((value >> np.uint64(11)).astype(np.float64))[1] + 11
    top = np.where(value >> np.uint64(11) == 0, np.frexp(value.astype(np.float64))[1], top)
    zeros = np.minimum(63 - top, 62)
    shift = (top - 1 - MANTISSA_BITS).astype(np.int64)
    mantissa = np.where(
        shift >= 0, value >> np.maximum(shift, 0).astype(np.uint64), value << np.maximum(-shift, 0).astype(np.uint64)
    ) & np.uint64((1 << MANTISSA_BITS) - 1)
    packed_registers = (zeros.astype(np.uint16) << MANTISSA_BITS) | mantissa.astype(np.uint16)
    packed_registers[table == _EMPTY] = 65535
    return packed_registers.reshape(-1, REGISTERS)


def band_keys(sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every band and whether it has a register that is not empty."""
    banded = sketch.reshape(len(sketch), BANDS, BAND_REGISTERS)
    keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64) + np.uint64(1), banded.shape[:2]).copy()
    for k in range(BAND_REGISTERS):
        keys = B.mixed(keys * B.MULTIPLIER + banded[:, :, k])
    return keys, (banded != 65535).any(axis=2)


def equal_by_chance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Chance that a register of two disjoint sets of sizes a and b is equal and filled."""
    x, y = a[:, None] / REGISTERS, b[:, None] / REGISTERS
    i = np.arange(1, 40)[None, :]
    step = 2.0 ** (-i - MANTISSA_BITS)
    count = 2.0**MANTISSA_BITS
    both = (x + y) * step
    series = np.exp(-(x + y) * 2.0**-i) * np.expm1(-both * count) / np.expm1(-both)
    return np.minimum((series * np.expm1(-x * step) * np.expm1(-y * step)).sum(axis=1), 0.5)


def estimate(a: np.ndarray, b: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Corrected Jaccard estimates of sketch rows and their standard errors at 0.75."""
    filled = (a != 65535) | (b != 65535)
    n = np.maximum(filled.sum(axis=1), 1)
    equal = ((a == b) & filled).sum(axis=1) / n
    # few sizes differ among many pairs; sets have fewer than 2**32 shingles
    sizes, at = np.unique(sizes_a.astype(np.int64) << 32 | sizes_b.astype(np.int64), return_inverse=True)
    chance = equal_by_chance((sizes >> 32).astype(float), (sizes & 0xFFFFFFFF).astype(float))[at]
    return (equal - chance) / (1 - chance), np.sqrt(0.75 * 0.25 / n)


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, content, bounds in B.slices(batch.column("text"), SLICE_BYTES):
            found, offsets = shingles(content, bounds)
            sketch = registers(found, offsets)
            keys, used = band_keys(sketch)
            sizes = np.diff(offsets)
            digest = np.stack([_sums(B.mixed(found ^ salt), offsets) for salt in DIGEST_SALTS], axis=1)
            ends = np.concatenate(([0], np.cumsum(used.sum(axis=1)))).astype(np.int32)
            width = pa.binary(2 * REGISTERS)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(row, len(bounds) - 1),
                    pa.array(sizes.astype(np.int64)),
                    pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(sizes), [None, pa.py_buffer(digest.tobytes())]).cast(pa.binary()),
                    pa.FixedSizeBinaryArray.from_buffers(width, len(sizes), [None, pa.py_buffer(sketch.tobytes())]).cast(pa.binary()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[used].view(np.int64))),
                ],
                names=["doc_id", "n_shingles", "digest", "sketch", "keys"],
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, content, bounds in B.slices(batch.column("text"), SLICE_BYTES):
            found, offsets = shingles(content, bounds)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("class_id").slice(row, len(bounds) - 1),
                    pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(found.view(np.int64))),
                ],
                names=["class_id", "set"],
            )


def _sets_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """class_id and set of the texts whose class_id a bitmap of ``ids`` may hold; no text is shuffled.

    Picked and cut into shingles by one Python worker, as a second one would hold as much memory again.
    """
    bitmap, at = bitmap_of(ids, F.col("class_id")), docs.columns.index("class_id")

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _sets(held_rows(batches, at, bitmap))

    return docs.mapInArrow(made, "class_id long, set array<long>")


def _passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        left, right = (
            np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS) for c in ("sketch_a", "sketch_b")
        )
        size_a, size_b = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("n_a", "n_b"))
        score, error = estimate(left, right, size_a, size_b)
        keep = score + SLACK * error >= SIMILAR[0] / SIMILAR[1]
        picked = batch.select(["a", "b"]).filter(pa.array(keep))
        yield pa.RecordBatch.from_arrays([*picked.columns, pa.array(score[keep])], names=["a", "b", "score"])


def sketched(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_shingles, digest of the shingle set, registers and band keys of every row."""
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")
    )
    return rows.mapInArrow(
        _sketches, "doc_id long, n_shingles long, digest binary, sketch binary, keys array<long>"
    )


def _star_pairs(members: DataFrame, key: list[str], salt: int) -> DataFrame:
    """Every member of a group beside the two members with the extreme hashes.

    There are ``DRAWS`` hashes, and a group has one of them. Classes that share many
    bands so meet the same few others in most of them and make few distinct pairs.
    """
    draw = F.pmod(F.xxhash64(*key), F.lit(DRAWS))
    drawn = F.struct(F.xxhash64(F.lit(salt), draw, "class_id").alias("h"), F.col("class_id").alias("id"))
    hubs = (
        members.groupBy(*key)
        .agg(F.min(drawn)["id"].alias("low"), F.max(drawn)["id"].alias("high"))
        .where("low <> high")
    )
    met = members.join(hubs, key).select(
        "class_id", F.explode(F.array_distinct(F.array("low", "high"))).alias("hub")
    )
    return met.where("class_id <> hub").select(
        F.least("class_id", "hub").alias("a"), F.greatest("class_id", "hub").alias("b")
    ).distinct()


def _estimated(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    def side(name: str) -> DataFrame:
        return classes.select(
            F.col("class_id").alias(name), F.col("n_shingles").alias(f"n_{name}"), F.col("sketch").alias(f"sketch_{name}")
        )

    sized = pairs.join(side("a"), "a").join(side("b"), "b")
    close = F.least("n_a", "n_b") * SIMILAR[1] >= F.greatest("n_a", "n_b") * SIMILAR[0]
    return sized.where(close).mapInArrow(_passing, "a long, b long, score double")


def similar_enough(set_a: Column, set_b: Column) -> Column:
    both = F.size(F.array_intersect(set_a, set_b))
    return both * SIMILAR[1] >= (F.size(set_a) + F.size(set_b) - both) * SIMILAR[0]


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full shingle sets are similar enough."""
    left = sets.select(F.col("class_id").alias("a"), F.col("set").alias("set_a"))
    right = sets.select(F.col("class_id").alias("b"), F.col("set").alias("set_b"))
    return pairs.join(left, "a").join(right, "b").where(similar_enough(F.col("set_a"), F.col("set_b"))).select("a", "b")


def _labelled(ids: DataFrame, links: DataFrame, column: str) -> DataFrame:
    groups = components(links)
    return ids.join(groups.withColumnRenamed("node", column), column, "left").withColumn(
        "component", F.coalesce("component", F.col(column))
    )


class _Linker:
    """Confirms candidate pairs and keeps the components of what was confirmed."""

    def __init__(self, docs: DataFrame, classes: DataFrame):
        self.docs, self.classes = docs, classes
        self.ids = classes.select("class_id").distinct()
        self.links: DataFrame | None = None
        self.groups = self.ids.withColumn("component", F.col("class_id"))

    def try_pairs(self, pairs: DataFrame) -> None:
        """Confirm pairs in different components; the best one of each class first, then
        those still in different components."""
        rest = settled(_estimated(pairs if self.links is None else self.apart(pairs), self.classes), "near-pairs")
        ends = rest.select(F.col("a").alias("class_id")).union(rest.select("b")).distinct()
        # what the bitmap lets through in vain finds no pair below
        sets = settled(_sets_of(self.docs, ends), "near-sets")
        both = rest.select("a", "b", "score").union(rest.select("b", "a", "score"))
        best = both.groupBy("a").agg(F.max_by("b", F.struct("score", F.hash("a", "b"), "b")).alias("b"))
        first = best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        for chosen in (first, rest.select("a", "b")):
            new = settled(_confirmed(self.apart(chosen), sets), "near-links")
            if new.isEmpty():
                continue
            self.links = new if self.links is None else self.links.union(new)
            self.groups = settled(_labelled(self.ids, self.links, "class_id"), "near-groups")

    def try_rest(self, members: DataFrame) -> None:
        """Confirm all pairs in different components that share a band."""
        tile = ["key", "i", "j"]
        met = _tiles(members, self.groups, self.classes).groupBy(*tile).applyInArrow(_tile_rows, _TILE_ROWS)
        rest = settled(met, "near-rest")
        if rest.isEmpty():
            return
        # thin tiles give their few pairs, crowds the classes that their pairs are made of
        pairs, crowds = rest.where("b IS NOT NULL").select("a", "b"), rest.where("b IS NULL").drop("b")
        sets = settled(_sets_of(self.docs, rest.select(F.col("a").alias("class_id")).union(pairs.select("b")).distinct()), "near-rest-sets")
        thin = _confirmed(pairs.distinct(), sets)
        met_again = crowds.join(sets.withColumnRenamed("class_id", "a"), "a").where(F.size("set") == F.col("n_shingles"))
        crowded = met_again.withColumnRenamed("a", "class_id").groupBy(*tile).applyInArrow(_tile_links, "a long, b long")
        new = settled(thin.union(crowded), "near-links")
        if not new.isEmpty():
            self.links = new if self.links is None else self.links.union(new)
            self.groups = settled(_labelled(self.ids, self.links, "class_id"), "near-groups")

    def apart(self, pairs: DataFrame) -> DataFrame:
        left = self.groups.select(F.col("class_id").alias("a"), F.col("component").alias("ca"))
        right = self.groups.select(F.col("class_id").alias("b"), F.col("component").alias("cb"))
        return pairs.join(left, "a").join(right, "b").where("ca <> cb").select("a", "b")


def _tiles(members: DataFrame, groups: DataFrame, classes: DataFrame) -> DataFrame:
    """Sketches of the band groups with several components, dealt to tiles (key, i, j).

    Side 0 holds a slice of the classes outside the group's largest component, side 1 a
    slice of all. Groups of three are left out: there the two hubs have met everyone.
    """
    sizes = classes.groupBy("class_id").agg(F.max("n_shingles").alias("n_shingles"))
    placed = members.join(groups, "class_id").join(sizes, "class_id")
    parts = placed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("w"))

    def slices(n: Column, w: Column) -> Column:
        return F.greatest(F.ceil(n / F.lit(TILE)), F.ceil(w / F.lit(TILE_SHINGLES))).cast("int")

    main = F.max(F.struct("n", "component", "w"))
    split = (
        parts.groupBy("key")
        .agg(F.sum("n").alias("n"), F.sum("w").alias("w"), main.alias("main"), F.count(F.lit(1)).alias("parts"))
        .where("parts > 1 AND n > 3")
        .select(
            "key",
            F.col("main.component").alias("main"),
            slices(F.col("n") - F.col("main.n"), F.col("w") - F.col("main.w")).alias("rows"),
            slices(F.col("n"), F.col("w")).alias("columns"),
        )
    )
    dealt = members.join(split, "key").join(groups, "class_id")
    slot = F.xxhash64(F.lit("tile"), "class_id")
    i, j = F.pmod(slot, "rows").cast("int"), F.pmod(slot, "columns").cast("int")

    def every(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    outside = F.col("component") != F.col("main")
    few = dealt.where(outside).select("key", i.alias("i"), every("columns").alias("j"), F.lit(0).alias("side"), "class_id", "component", outside.alias("outside"))
    many = dealt.select("key", every("rows").alias("i"), j.alias("j"), F.lit(1).alias("side"), "class_id", "component", outside.alias("outside"))
    return few.unionByName(many).join(classes, "class_id")


_TILE_ROWS = (
    "key long, i int, j int, a long, b long, side int, component long, outside boolean, n_shingles long, sketch binary"
)


def _tile_pairs(tile: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """Row numbers of a class of side 0 and of those of side 1 in other components that pass the estimate
    with it, each pair in its first common band."""
    key = tile.column("key")[0].as_py()
    sketch = np.frombuffer(b"".join(tile.column("sketch").to_pylist()), np.uint16).reshape(-1, REGISTERS)
    keys, used = band_keys(sketch)
    own = (keys.view(np.int64) == key) & used
    has = own.any(axis=1)
    band = int(np.argmax(own.any(axis=0)))
    side, ids, component, size, outside = (
        tile.column(c).to_numpy() for c in ("side", "class_id", "component", "n_shingles", "outside")
    )
    rows, columns = np.flatnonzero(has & (side == 0)), np.flatnonzero(has & (side == 1))
    for r in rows:
        least, most = np.minimum(size[r], size[columns]), np.maximum(size[r], size[columns])
        # two classes outside meet in two tiles
        meet = (component[columns] != component[r]) & (~outside[columns] | (ids[r] < ids[columns]))
        c = columns[meet & (least * SIMILAR[1] >= most * SIMILAR[0])]
        if not len(c):
            continue
        banded = (sketch[c, : band * BAND_REGISTERS] == sketch[r, : band * BAND_REGISTERS]).reshape(len(c), band, BAND_REGISTERS)
        c = c[~(banded.all(axis=2) & used[r, :band]).any(axis=1)]
        if not len(c):
            continue
        score, error = estimate(np.broadcast_to(sketch[r], (len(c), REGISTERS)), sketch[c], np.full(len(c), size[r]), size[c])
        c = c[score + SLACK * error >= SIMILAR[0] / SIMILAR[1]]
        if len(c):
            yield r, c


def _tile_rows(tile: pa.Table) -> pa.Table:
    """The pairs (a, b) of a tile that pass the estimate; of a crowd of pairs only the classes ``a`` in them, with
    what tells the pairs again, so that no more rows leave a tile than it has or a few."""
    found = list(_tile_pairs(tile))
    if sum(len(c) for _, c in found) < CROWD:
        at = np.repeat([r for r, _ in found], [len(c) for _, c in found]).astype(np.int64)
        b = tile.column("class_id").take(pa.array(np.concatenate([c for _, c in found]) if found else at))
    else:
        in_pair = np.zeros(tile.num_rows, bool)
        for r, c in found:
            in_pair[r] = in_pair[c] = True
        at = np.flatnonzero(in_pair)
        b = pa.nulls(len(at), pa.int64())
    rows = tile.take(pa.array(at)).rename_columns(["a" if c == "class_id" else c for c in tile.column_names])
    return rows.append_column("b", b).select([c.split()[0] for c in _TILE_ROWS.split(", ")])


def _tile_links(tile: pa.Table) -> pa.Table:
    """The pairs of one tile whose full sets are similar enough, without those that others of the tile imply."""
    tile = tile.combine_chunks()
    shingle = tile.column("set").combine_chunks()
    flat = np.unique(shingle.flatten().to_numpy(zero_copy_only=False), return_inverse=True)[1]
    lengths = tile.column("n_shingles").to_numpy()
    starts = np.cumsum(lengths) - lengths
    ids = tile.column("class_id").to_numpy()
    parent = np.arange(len(ids))
    parent = parent[np.unique(ids, return_index=True)[1][np.unique(ids, return_inverse=True)[1]]]

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    mark = np.zeros(int(flat.max()) + 1, bool)
    left, right = [], []
    for r, c in _tile_pairs(tile):
        mine = flat[starts[r] : starts[r] + lengths[r]]
        at = np.array([n for n in c if find(n) != find(r)], np.int64)
        if not len(at):
            continue
        ends = np.cumsum(lengths[at])
        where = np.repeat(starts[at] - (ends - lengths[at]), lengths[at]) + np.arange(ends[-1])
        mark[mine] = True
        both = np.add.reduceat(mark[flat[where]], ends - lengths[at], dtype=np.int64)
        mark[mine] = False
        for n in at[both * SIMILAR[1] >= (lengths[r] + lengths[at] - both) * SIMILAR[0]]:
            x, y = find(r), find(n)
            if x != y:
                parent[max(x, y)] = min(x, y)
                left.append(min(ids[r], ids[n]))
                right.append(max(ids[r], ids[n]))
    return pa.table({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})


def _grouped(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    rows = settled(
        sketched(docs, id_column, text_column).withColumn("run", F.pmod(F.xxhash64("doc_id"), F.lit(RUNS))),
        "near-sketches",
    )
    usable = rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # one class per shingle set, named after its smallest document; first by runs, which
    # also spread the copies of one text when the answer goes back to them
    first = usable.groupBy("digest", "n_shingles", "run").agg(
        F.min("doc_id").alias("doc_id"), F.min_by("sketch", "doc_id").alias("sketch"), F.min_by("keys", "doc_id").alias("keys")
    )
    classes = settled(
        first.groupBy("digest", "n_shingles").agg(
            F.min("doc_id").alias("class_id"), F.min_by("sketch", "doc_id").alias("sketch"), F.min_by("keys", "doc_id").alias("keys")
        ),
        "near-classes",
    )
    texts = docs.select(F.col(id_column).cast("long").alias("class_id"), F.col(text_column).cast("string").alias("text"))
    linker = _Linker(texts, classes.select("class_id", "n_shingles", "sketch"))
    members = classes.select("class_id", F.explode("keys").alias("key"))
    linker.try_pairs(_star_pairs(members, ["key"], 0))
    linker.try_rest(members)
    named = classes.select("digest", "n_shingles", "class_id").join(linker.groups, "class_id").drop("class_id")
    spread = usable.select("digest", "n_shingles", "run").distinct().join(named, ["digest", "n_shingles"])
    return rows.select("doc_id", "digest", "n_shingles", "run").join(spread, ["digest", "n_shingles", "run"], "left")


def near_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row.

    Texts are lower-cased (A-Z) and cut into words; sets hold the distinct runs of
    five words, or the whole sequence of a shorter text. Sets with
    100 * intersection >= 75 * union are linked, components are those of the links
    and named after their smallest id. Null and empty texts have no shingles and are
    linked with nothing. Rows that repeat an id are judged by their own texts, and
    texts with the same smallest id count as one document. Rows with a null id get
    the component of equal texts or none. An empty table gives an empty result.
    Columns besides id and text play no part.
    """
    grouped = _grouped(docs, id_column, text_column)
    component = F.coalesce("component", "doc_id")
    return grouped.select(
        "doc_id", "n_shingles", component.alias("component_id"), (F.col("doc_id") == component).alias("kept")
    )


def drop_near_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` without the documents that :func:`near_groups` does not keep.

    Rows with a null id stay.
    """
    marked = near_groups(docs, id_column, text_column)
    dropped = settled(marked.where("NOT kept").select("doc_id").distinct(), "near-dropped")
    return packed(docs, id_column, text_column).drop("text").join(dropped, "doc_id", "left_anti").select("row.*")
