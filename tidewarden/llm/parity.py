"""N-gram Jaccard join by parity sketches.

A sketch hashes every shingle of a set to a bit and keeps the parity of each bit. A shingle
that only one of two sets holds flips one bit, so the Hamming distance of two sketches is at
most the sets' symmetric difference. Sets of sizes a and b with Jaccard similarity of at
least 85/100 differ in at most D = (a + b) * 15 / 185 shingles.

Join: sizes are cut into bands; sets meet in the band of the larger one, so a set takes part in its own band and,
if it is large enough to match there, in the next. In a band a sketch has S = D + 1 + spare words of 64 bits, D for
the band's largest sizes. Similar sets differ in D words at most, so spare + 1 words are equal at least.
A set with at most ``spare`` words that are zero has a word that is equal and not zero in common with each
of its matches, and leaves its zero words out. The few other sets take part under
further hashes, with all words under the last one; so the zero word, which unlike sets share, makes no crowd.

Candidates share a word, and one of them has its own band there. In every group of a word all sets first meet one set of the band;
with that, groups with a single such set are complete. Groups with a great part of the rows are cut by name before, and
their parts' smallest names meet. In the other groups every two sets of different components are then compared,
large groups in tiles of bounded size: the nearest partner of each set goes on first, and where that leaves pairs out,
the group is gone through again with all that are still in different components.

A candidate pair must pass the Hamming bound of a sketch and is then verified on the full shingle sets, taken from the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shuffle_partitions
from . import bytescan as B
from .common import settled
from .links import components
from .membership import bitmap_of, possible
from .near import DIGEST_SALTS, shingles

WIDTH = 4
#: 100 * intersection >= 85 * union, hence 185 * difference <= 15 * (a + b).
SIMILAR = (85, 100)
APART = (SIMILAR[1] - SIMILAR[0], SIMILAR[1] + SIMILAR[0])
#: Sets below this size can only match equal sets.
LEAST_SIZE = 6
#: Hashes tried for sets with too many zero words.
DRAWS = 4
TILE = 1024
PAIRS = 1 << 19
#: Names end in a code of the set's size, one per SIZE_STEP, and a bit that tells the next band from the own one.
NAME_BITS, SIZE_STEP = 8, 1.08
RUNS = 64
#: One class in so many is counted to find words that a great part of the sets share.
SAMPLED, HOT, PARTS = 16, 64, 64
EARLY = 4
SLICE_BYTES = 1 << 19
_ONE = np.uint64(1)
_SALTS = B.mixed(np.arange(1, DRAWS + 2, dtype=np.uint64) * B.MULTIPLIER)


def apart_at_most(sizes: np.ndarray) -> np.ndarray:
    """Largest symmetric difference of similar sets whose sizes add up to ``sizes``."""
    return sizes * APART[0] // APART[1]


def band_tops(largest: int) -> np.ndarray:
    """Largest size of every band; a set matches in its own band and the next one at most."""
    tops = [LEAST_SIZE]
    while tops[-1] < largest:
        tops.append(tops[-1] * SIMILAR[1] ** 2 // SIMILAR[0] ** 2 + 1)
    return np.array(tops, np.int64)


def band_shape(top: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of words and of spare words of the sketches of a band."""
    most = apart_at_most(2 * top)
    spare = np.maximum(1, -(-most // 20))
    return most + 1 + spare, spare


def _scattered(found: np.ndarray, offsets: np.ndarray, rows: np.ndarray, words: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Parity words of some rows, each with its own number of words, and where each row's begin."""
    base = np.concatenate(([0], np.cumsum(words)))
    counts = (offsets[1:] - offsets[:-1])[rows]
    firsts = np.cumsum(counts) - counts
    at = np.arange(counts.sum()) - np.repeat(firsts - offsets[rows], counts)
    h = B.mixed(found[at] ^ _SALTS[salt])
    place = (h % np.repeat(words, counts).astype(np.uint64)).astype(np.int64) + np.repeat(base[:-1], counts)
    table = np.zeros(base[-1], np.uint64)
    np.bitwise_xor.at(table, place, _ONE << (h >> np.uint64(58)))
    return table, base


def size_codes(sizes: np.ndarray) -> np.ndarray:
    return np.minimum(np.log(np.maximum(sizes, 1)) / np.log(SIZE_STEP), (1 << (NAME_BITS - 1)) - 1).astype(np.uint64)


#: Codes of sizes that can match differ by no more; codes round down and sizes beyond the last code share it.
CODES_APART = int(np.log(SIMILAR[1] / SIMILAR[0]) / np.log(SIZE_STEP)) + 1


def word_keys(found: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the words that each row takes part with, the row of each key, and whether it is of the next band."""
    sizes = np.diff(offsets)
    tops = band_tops(int(sizes.max(initial=0)))
    band = np.searchsorted(tops, sizes)
    own = np.flatnonzero(sizes > LEAST_SIZE)
    upper = np.flatnonzero((sizes >= LEAST_SIZE) & (SIMILAR[1] * sizes >= SIMILAR[0] * (tops[band] + 1)))
    rows, bands = np.concatenate((own, upper)), np.concatenate((band[own], band[upper] + 1))
    next_band = np.arange(len(rows)) >= len(own)
    keys, owner, beyond = [], [], []
    # the next band's top follows from the same rule, also above the largest size here
    tops = band_tops(int(tops[-1]) + 1)
    for draw in range(DRAWS):
        if not len(rows):
            break
        words, spare = band_shape(tops[bands])
        table, base = _scattered(found, offsets, rows, words, draw + 1)
        of = np.repeat(np.arange(len(rows)), words)
        zero = table == 0
        poor = np.bincount(of[zero], minlength=len(rows)) > spare
        kept = ~zero if draw + 1 < DRAWS else ~zero | poor[of]
        place = (np.arange(len(table)) - base[of]).astype(np.uint64)
        label = B.mixed((bands[of].astype(np.uint64) * np.uint64(DRAWS) + np.uint64(draw)) * B.MULTIPLIER + place)
        keys.append(B.mixed(table * B.MULTIPLIER ^ label)[kept])
        owner.append(rows[of[kept]])
        beyond.append(next_band[of[kept]])
        rows, bands, next_band = rows[poor], bands[poor], next_band[poor]
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, bool)
    return np.concatenate(keys), np.concatenate(owner), np.concatenate(beyond)


def folding_sketches(found: np.ndarray, offsets: np.ndarray, bits_each: float) -> tuple[np.ndarray, np.ndarray]:
    """Sketches whose number of words is a power of two near ``bits_each`` per shingle, and their offsets."""
    sizes = np.maximum(np.diff(offsets) * bits_each / 64, 1)
    words = 1 << np.ceil(np.log2(sizes)).astype(np.int64)
    return _scattered(found, offsets, np.arange(len(sizes)), words, 0)


COARSE, FINE = 0.5, 2.0


def distances(left: list[bytes], right: list[bytes], length_a: np.ndarray, length_b: np.ndarray) -> np.ndarray:
    """Hamming distances of folding sketches; the longer one of a pair is folded to the other's length."""
    out = np.zeros(len(left), np.int64)
    kinds = length_a * (1 << 32) + length_b
    for kind in np.unique(kinds):
        at = np.flatnonzero(kinds == kind)
        a, b = (
            np.frombuffer(b"".join([side[i] for i in at]), np.uint64).reshape(len(at), -1) for side in (left, right)
        )
        while a.shape[1] > b.shape[1]:
            a = a[:, : a.shape[1] // 2] ^ a[:, a.shape[1] // 2 :]
        while b.shape[1] > a.shape[1]:
            b = b[:, : b.shape[1] // 2] ^ b[:, b.shape[1] // 2 :]
        out[at] = np.bitwise_count(a ^ b).sum(axis=1)
    return out


def _binaries(table: np.ndarray, base: np.ndarray, keep: np.ndarray) -> pa.Array:
    whole = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(base) - 1, [None, pa.py_buffer((base * 8).astype(np.int64).tobytes()), pa.py_buffer(table.tobytes())]
    )
    nothing = pa.nulls(len(base) - 1, pa.large_binary())
    return pc.if_else(pa.array(keep), whole, nothing).cast(pa.binary())


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


_ROWS = "doc_id long, mark long, n_shingles long, digest binary, name long, coarse binary, fine binary, keys array<long>, n_own int"
#: Classes that a task remembers, to give the sketches and words of copies once.
REMEMBERED = 1 << 18


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: set[bytes] = set()
    for batch in batches:
        for row, content, bounds in B.slices(batch.column("text"), SLICE_BYTES):
            found, offsets = shingles(content, bounds, WIDTH)
            sizes = np.diff(offsets)
            digest = np.stack([_sums(B.mixed(found ^ salt), offsets) for salt in DIGEST_SALTS], axis=1)
            name = B.mixed(digest[:, 0] * B.MULTIPLIER ^ digest[:, 1]) >> np.uint64(NAME_BITS) << np.uint64(NAME_BITS)
            name |= size_codes(sizes) << _ONE
            held = [d.tobytes() for d in digest]
            ids = batch.column("doc_id").slice(row, len(sizes))
            first = np.zeros(len(sizes), bool)
            for k in np.flatnonzero((sizes > 0) & ids.is_valid().to_numpy(zero_copy_only=False)):
                if held[k] not in seen:
                    first[k] = True
                    seen.add(held[k])
            if len(seen) > REMEMBERED:
                seen.clear()
            keys, owner, beyond = word_keys(found, offsets)
            used = first[owner]
            keys, owner, beyond = keys[used], owner[used], beyond[used]
            order = np.lexsort((beyond, owner))
            ends = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(sizes)))))
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    batch.column("mark").slice(row, len(sizes)),
                    pa.array(sizes.astype(np.int64)),
                    pa.array(held, pa.binary()),
                    pa.array(name.view(np.int64)),
                    _binaries(*folding_sketches(found, offsets, COARSE), first),
                    _binaries(*folding_sketches(found, offsets, FINE), first),
                    pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(keys[order].view(np.int64))),
                    pa.array(np.bincount(owner[~beyond], minlength=len(sizes)).astype(np.int32)),
                ],
                names=["doc_id", "mark", "n_shingles", "digest", "name", "coarse", "fine", "keys", "n_own"],
            )


def _passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        left, right = batch.column("sketch_a").to_pylist(), batch.column("sketch_b").to_pylist()
        length_a, length_b = np.array([len(x) for x in left]), np.array([len(x) for x in right])
        size = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
        far = distances(left, right, length_a, length_b)
        keep = far <= apart_at_most(size)
        picked = batch.select(["a", "b"]).filter(pa.array(keep))
        yield pa.RecordBatch.from_arrays([*picked.columns, pa.array(far[keep] / size[keep])], names=["a", "b", "far"])


def similar_sets(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both * SIMILAR[1] >= (len(a) + len(b) - both) * SIMILAR[0]


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose full shingle sets are similar; the sets come from the texts.

    Rows come sorted by ``b``, whose set is made once for all its partners.
    """
    last: tuple[str | None, np.ndarray] = (None, np.zeros(0, np.uint64))
    for batch in batches:
        keep = np.zeros(batch.num_rows, bool)
        for row, content, bounds in B.slices(batch.column("text_a"), SLICE_BYTES):
            found, offsets = shingles(content, bounds, WIDTH)
            others = batch.column("text_b").slice(row, len(bounds) - 1)
            for k, text in enumerate(others):
                other = text.as_py()
                if other != last[0]:
                    last = (other, shingles(*B.utf8(pa.array([other])), WIDTH)[0])
                keep[row + k] = similar_sets(found[offsets[k] : offsets[k + 1]], last[1])
        yield batch.select(["ca", "cb"]).filter(pa.array(keep))


def _size_fits(a: Column, b: Column) -> Column:
    return F.least(a, b) * SIMILAR[1] >= F.greatest(a, b) * SIMILAR[0]


class _Linker:
    """Verifies candidate pairs of classes and keeps the components of what was verified."""

    def __init__(self, docs: DataFrame, classes: DataFrame):
        self.docs, self.classes = docs, classes
        self.groups = classes.select("class_id").distinct().withColumn("component", F.col("class_id"))

    def verify(self, pairs: DataFrame, label: str) -> None:
        """Verify pairs (a, b) of different components on their full sets and join what is similar."""
        rest = settled(self._apart(pairs), f"parity-{label}-pairs")
        if rest.isEmpty():
            return
        ends = settled(self._texts(rest.select(F.col("a").alias("class_id")).union(rest.select("b")).distinct()), f"parity-{label}-texts")
        one = ends.select(F.col("class_id").alias("a"), F.col("text").alias("text_a"))
        other = ends.select(F.col("class_id").alias("b"), F.col("text").alias("text_b"))
        met = rest.join(one, "a").join(other, "b").select("ca", "cb", "text_a", "text_b")
        new = settled(met.mapInArrow(_verified, "ca long, cb long"), f"parity-{label}-links")
        if not new.isEmpty():
            self._merge(new, label)

    def _merge(self, new: DataFrame, label: str) -> None:
        """Join the components that new links connect; only their names take part in the rounds."""
        merged = components(new.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
        named = merged.select(F.col("node").alias("component"), F.col("component").alias("into"))
        moved = self.groups.join(named, "component", "left")
        self.groups = settled(moved.select("class_id", F.coalesce("into", "component").alias("component")), f"parity-{label}-groups")

    def _texts(self, ends: DataFrame) -> DataFrame:
        """One text of each class; rows that cannot be one are left out before any shuffle where the bitmap tells."""
        texts = possible(self.docs, "class_id", bitmap_of(ends, F.col("class_id")))
        wanted = self.classes.select("class_id", "mark").join(ends, "class_id")
        return texts.join(wanted, ["class_id", "mark"]).dropDuplicates(["class_id", "mark"]).select("class_id", "text")

    def _apart(self, pairs: DataFrame) -> DataFrame:
        left = self.groups.select(F.col("class_id").alias("a"), F.col("component").alias("ca"))
        right = self.groups.select(F.col("class_id").alias("b"), F.col("component").alias("cb"))
        return pairs.join(left, "a").join(right, "b").where("ca <> cb")


def _base(name: str) -> Column:
    """A name without the bit of the band."""
    return F.col(name).bitwiseAND(F.lit(~1))


def _members(rows: DataFrame) -> DataFrame:
    """key, name, hub, owns and n for every word that several classes share.

    ``hub`` is the smallest name of the word's own band, ``owns`` counts the rows of that band, ``n`` all. Words that
    a great part of the classes share are found in a sample of the classes, one per shuffle partition at
    most, and their groups cut into parts by name (``hot``).
    """
    at = rows.where(F.size("keys") > 0).select(F.posexplode("keys").alias("at", "key"), "name", "n_own")
    keys = at.select("key", F.col("name").bitwiseOR((F.col("at") >= F.col("n_own")).cast("long")).alias("name"))
    sample = keys.where(F.pmod(F.shiftright("name", NAME_BITS), F.lit(SAMPLED)) == 0)
    counts = sample.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= HOT)
    hot = counts.orderBy(F.desc("n")).limit(shuffle_partitions(rows.sparkSession)).select("key", F.lit(True).alias("hot"))
    part = F.when(F.col("hot"), F.pmod(F.xxhash64("name"), F.lit(PARTS))).otherwise(F.lit(0)).cast("short")
    dealt = keys.join(F.broadcast(hot), "key", "left").select("key", "name", part.alias("part"), F.coalesce("hot", F.lit(False)).alias("hot"))
    group = Window.partitionBy("key", "part")
    own = F.when(F.col("name").bitwiseAND(F.lit(1)) == 0, F.col("name"))
    counted = dealt.select(
        "key", "name", "hot", F.min(own).over(group).alias("least"), F.count(own).over(group).cast("int").alias("owns"),
        F.count(F.lit(1)).over(group).cast("int").alias("n"),
        F.min(_base("name")).over(group).alias("low"), F.max(_base("name")).over(group).alias("high"),
    )
    hub = F.coalesce("least", F.when(F.col("hot"), F.col("low"))).alias("hub")
    return counted.where("hot OR low <> high AND least IS NOT NULL").select("key", "name", hub, "owns", "n", "hot")


#: Groups that the hub does not complete.
_OPEN = "hot OR owns > 1 AND n > 2"


def _sizes_fit(x: Column, y: Column) -> Column:
    """By the codes in the names; lets too many through, never too few."""
    code = lambda name: F.shiftright(name, 1).bitwiseAND(F.lit((1 << (NAME_BITS - 1)) - 1))
    return F.abs(code(x) - code(y)) <= CODES_APART


def _first_pairs(members: DataFrame) -> DataFrame:
    """Every member beside the hub of its group; parts of a group beside each other's hubs.

    Groups that are compared in full later take part with one word in ``EARLY``: similar sets share
    a third of their words, so most links are found and joined here, before pairs are formed.
    """
    now = ~F.expr(_OPEN) | F.col("hot") | (F.pmod("key", F.lit(EARLY)) == 0)
    met = members.where(now).select(_base("name").alias("name"), F.col("hub").alias("other"))
    heads = members.where("hot").select("key", F.col("hub").alias("name")).distinct()
    head = heads.groupBy("key").agg(F.min("name").alias("other"))
    both = met.union(heads.join(head, "key").select("name", "other"))
    return both.where((F.col("name") != F.col("other")) & _sizes_fit(F.col("name"), F.col("other"))).select(
        F.least("name", "other").alias("x"), F.greatest("name", "other").alias("y")
    ).distinct()


def _nearest_pairs(pairs: DataFrame) -> DataFrame:
    """The pair of each class with the smallest distance."""
    both = pairs.select("a", "b", "far").union(pairs.select("b", "a", "far"))
    near = both.groupBy("a").agg(F.min(F.struct("far", "b")).alias("best"))
    return near.select(F.least("a", "best.b").alias("a"), F.greatest("a", "best.b").alias("b")).distinct()


def _passed(pairs: DataFrame, classes: DataFrame, sketch: str) -> DataFrame:
    """Pairs of names (x, y) as pairs of classes that pass the Hamming bound."""

    def side(name: str, end: str) -> DataFrame:
        return classes.select(
            F.col("name").alias(name), F.col("class_id").alias(end), F.col("n_shingles").alias(f"n_{end}"), F.col(sketch).alias(f"sketch_{end}")
        )

    sized = pairs.join(side("x", "a"), "x").join(side("y", "b"), "y").where(_size_fits(F.col("n_a"), F.col("n_b")) & (F.col("a") != F.col("b")))
    near = sized.select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b").mapInArrow(_passing, "a long, b long, far double")
    return near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "far")


_WIDE = ["key", "i", "j", "side", "class_id", "component", "outside", "upper", "n_shingles", "sketch"]
_FOUND = "a long, b long, far double, key long, more boolean"


def _known(classes: DataFrame, groups: DataFrame, sketch: str) -> DataFrame:
    return classes.select("name", "class_id", "n_shingles", F.col(sketch).alias("sketch")).join(groups, "class_id")


def _rest(members: DataFrame, groups: DataFrame, classes: DataFrame, sketch: str, every: bool) -> DataFrame:
    """Pairs of the groups with several components that pass the bound: all, or the nearest partner of each.

    ``more`` tells that a group has pairs which were left out.
    """
    known = _known(classes, groups, sketch)
    small = (F.col("n") <= TILE) & ~F.col("hot")
    rows = members.where(F.expr(_OPEN) & small).select("key", F.col("name").alias("member"))
    upper = (F.col("member").bitwiseAND(F.lit(1)) == 1).alias("upper")
    one_tile = rows.join(known, _base("member") == F.col("name")).select(
        "key", F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("side"), "class_id", "component",
        F.lit(True).alias("outside"), upper, "n_shingles", "sketch",
    )
    rows = members.where(F.expr(_OPEN) & ~small).select("key", F.col("name").alias("member"))
    large = rows.join(known.drop("sketch", "n_shingles"), _base("member") == F.col("name")).withColumn("upper", upper)
    tiled = _tiles(large).join(classes.select("class_id", "n_shingles", F.col(sketch).alias("sketch")), "class_id").select(*_WIDE)
    order = _WIDE[:4]
    dealt = one_tile.unionByName(tiled).repartition(*order[:3]).sortWithinPartitions(*order)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _tile_pairs(batches, every)

    return dealt.mapInArrow(pairs, _FOUND)


def _tiles(large: DataFrame) -> DataFrame:
    """Members of large groups with several components, dealt to tiles (key, i, j).

    Side 1 holds a slice of the classes outside the group's largest component, side 2 a slice of all.
    """
    placed = large.groupBy("key", "class_id", "component").agg(F.min("upper").alias("upper"))
    parts = placed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    slices = lambda n: F.greatest(F.ceil(n / F.lit(TILE)), F.lit(1)).cast("int")
    split = (
        parts.groupBy("key")
        .agg(F.sum("n").alias("n"), F.max(F.struct("n", "component")).alias("main"), F.count(F.lit(1)).alias("parts"))
        .where("parts > 1")
        .select("key", F.col("main.component").alias("main"), slices(F.col("n") - F.col("main.n")).alias("rows"), slices(F.col("n")).alias("columns"))
    )
    slot = F.xxhash64(F.lit("tile"), "class_id")
    dealt = placed.join(split, "key").withColumn("outside", F.col("component") != F.col("main"))
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    same = ["class_id", "component", "outside", "upper"]
    few = dealt.where("outside").select("key", F.pmod(slot, "rows").cast("int").alias("i"), every("columns").alias("j"), F.lit(1).alias("side"), *same)
    many = dealt.select("key", every("rows").alias("i"), F.pmod(slot, "columns").cast("int").alias("j"), F.lit(2).alias("side"), *same)
    return few.unionByName(many)


def _tile_pairs(batches: Iterator[pa.RecordBatch], every: bool) -> Iterator[pa.RecordBatch]:
    """Pairs across components that pass the bound, from rows sorted by tile; a tile may span batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        whole = pa.Table.from_batches(held).combine_chunks()
        change = _tile_starts(whole)
        if len(change) > 1:
            yield from _pairs_of(whole.slice(0, change[-1]), change[:-1], every)
            held = whole.slice(change[-1]).to_batches()
    if held:
        whole = pa.Table.from_batches(held).combine_chunks()
        yield from _pairs_of(whole, _tile_starts(whole), every)


def _tile_starts(whole: pa.Table) -> np.ndarray:
    key, i, j = (whole.column(c).to_numpy() for c in _WIDE[:3])
    return np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]))))


def _pairs_of(whole: pa.Table, starts: np.ndarray, every: bool) -> Iterator[pa.RecordBatch]:
    """A small group is one tile of rows on side 0, which meet the rows behind them; side 1 meets side 2."""
    side, ids, component, size, outside, upper, key = (
        whole.column(c).to_numpy() for c in ("side", "class_id", "component", "n_shingles", "outside", "upper", "key")
    )
    ends = np.append(starts[1:], len(ids))
    tile = np.repeat(np.arange(len(starts)), ends - starts)
    second = starts + np.bincount(tile[side == 1], minlength=len(starts))
    mixed = np.maximum.reduceat(component, starts) != np.minimum.reduceat(component, starts)
    rows = np.flatnonzero((side < 2) & mixed[tile])
    begin = np.where(side[rows] == 0, rows + 1, second[tile[rows]])
    count = ends[tile[rows]] - begin
    sketch = length = None
    for part in np.split(np.arange(len(rows)), np.flatnonzero(np.diff(np.cumsum(count) // PAIRS)) + 1) if len(rows) else []:
        n = count[part]
        left = np.repeat(rows[part], n)
        right = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - begin[part], n)
        # two classes outside the largest component meet in two tiles; two of the next band meet in their own
        meet = (component[left] != component[right]) & ~(upper[left] & upper[right])
        meet &= (side[left] == 0) | ~outside[right] | (ids[left] < ids[right])
        meet &= np.minimum(size[left], size[right]) * SIMILAR[1] >= np.maximum(size[left], size[right]) * SIMILAR[0]
        left, right = left[meet], right[meet]
        if not len(left):
            continue
        if sketch is None:
            sketch = whole.column("sketch").to_pylist()
            length = np.array([len(x) for x in sketch], np.int64)
        near, far = [], []
        for at in range(0, len(left), 1 << 14):
            a, b = left[at : at + (1 << 14)], right[at : at + (1 << 14)]
            d = distances([sketch[k] for k in a], [sketch[k] for k in b], length[a], length[b])
            keep = np.flatnonzero(d <= apart_at_most(size[a] + size[b]))
            near.append(keep + at)
            far.append(d[keep] / (size[a[keep]] + size[b[keep]]))
        passed = np.concatenate(near)
        left, right, far = left[passed], right[passed], np.concatenate(far)
        more = np.zeros(len(left), bool)
        if not every and len(left):
            kept = np.unique(np.concatenate((_nearest(left, far), _nearest(right, far))))
            lost = np.bincount(tile[left], minlength=len(starts)) > np.bincount(tile[left[kept]], minlength=len(starts))
            left, right, far = left[kept], right[kept], far[kept]
            more = lost[tile[left]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.minimum(ids[left], ids[right])), pa.array(np.maximum(ids[left], ids[right])), pa.array(far), pa.array(key[left]), pa.array(more)],
            names=["a", "b", "far", "key", "more"],
        )


def _nearest(end: np.ndarray, far: np.ndarray) -> np.ndarray:
    """Position of the nearest pair of each row."""
    order = np.lexsort((far, end))
    return order[np.concatenate(([True], end[order][1:] != end[order][:-1]))]


def jaccard_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id of every row.

    Texts are lower-cased (A-Z) and cut into words; sets hold the distinct runs of four words, or the whole
    sequence of a shorter text. Sets with 100 * intersection >= 85 * union are
    linked, components are those of the links and named after their smallest id. Null and empty texts have
    no shingles and are linked with nothing. Rows that repeat an id are judged by their own
    texts, and texts with the same smallest id count as one document. Rows with a null id link
    with nothing and have no component. An empty table gives an empty result. Columns besides id and text play no part.

    Exact up to collisions of 64-bit shingle hashes.
    """
    plain = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    marked = plain.withColumn("mark", F.xxhash64("text"))
    run = F.pmod(F.xxhash64("doc_id"), F.lit(RUNS)).cast("int")
    rows = settled(marked.mapInArrow(_sketched, _ROWS).withColumn("run", run), "parity-sketches")
    usable = rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
    kind = ["digest", "n_shingles", "name"]

    def one(frame: DataFrame, *more: str) -> DataFrame:
        least = F.min(F.struct("doc_id", "mark")).alias("least")
        found = frame.groupBy(*kind, *more).agg(least, F.max("coarse").alias("coarse"), F.max("fine").alias("fine"))
        return found.select(*kind, *more, "least.*", "coarse", "fine")

    classes = settled(one(one(usable, "run")).withColumnRenamed("doc_id", "class_id"), "parity-classes")
    linker = _Linker(marked.withColumnRenamed("doc_id", "class_id").select("class_id", "text", "mark"), classes)
    members = settled(_members(rows), "parity-members")
    star = settled(_passed(_first_pairs(members), classes, "coarse"), "parity-star")
    linker.verify(_nearest_pairs(star), "first")
    near = settled(_rest(members, linker.groups, classes, "coarse", every=False), "parity-nearest")
    linker.verify(star.select("a", "b").union(near.select("a", "b")).distinct(), "near")
    unfinished = near.where("more").select("key").distinct()
    if not unfinished.isEmpty():
        # what the bitmap lets through in vain goes in the join
        some = possible(members, "key", bitmap_of(unfinished, F.col("key"))).join(unfinished, "key", "left_semi")
        linker.verify(_rest(some, linker.groups, classes, "fine", every=True).select("a", "b").distinct(), "rest")
    named = classes.select(*kind, "class_id").join(linker.groups, "class_id").drop("class_id")
    spread = usable.select(*kind, "run").distinct().join(named, kind)
    grouped = rows.select("doc_id", *kind, "run").join(spread, [*kind, "run"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return grouped.select("doc_id", "n_shingles", component.alias("component_id"))
