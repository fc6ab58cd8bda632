"""SentencePiece encoding by a streaming Viterbi search, and decoding.

The search runs over the characters of a text with spaces written as U+2581 and one
put in front. It looks back over the last ``longest`` positions only (no piece is
longer) and keeps the back-pointers since the last committed boundary. From time to time
the paths of all live positions are followed back; where they meet, everything before
is the same for every continuation, and its ids are committed and forgotten.

With a unigram model a path is as good as the sum of its scores, ties going to the
longer last piece. With a merge (BPE) model, such as the one at hand, sums of scores
mean nothing: a path is admissible if every two neighbours are what the merges make of
the two together. A text has exactly one admissible path, the model's own encoding,
so the search gives the ids of the SentencePiece library for either kind.

Boundaries that every path has, whatever follows, are known from the vocabulary: no
piece has a space after another character, and characters outside the alphabet of
the longer pieces stand alone. The text between two such boundaries always gives the
same ids, so these are kept in a table of bounded size.

Characters without a piece become byte pieces, U+2581 itself included, so decoding
gives back exactly the text.
"""

from __future__ import annotations

import itertools
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
UNKNOWN_PENALTY = 10.0
REMEMBERED = 300_000
#: For a sparing vocabulary: segments in each of the two tables, and slots that tell which ones were met before.
SEGMENTS = 150_000
MET = 1 << 21
SPACE = "▁"
SLICE_ROWS = 256


_NONE: dict[str, bool] = {}


def _automaton(scores: dict[str, float]) -> list:
    """The root of the beginnings of all pieces. A beginning is a list of its continuations by character, the pieces
    of several characters it ends with (longest first), and the longest other beginning it ends with."""
    root: list = [{}, (), None]
    level = [(root, "", sorted(p for p in scores if len(p) > 1))]
    while level:
        below = []
        for node, text, pieces in level:
            for c, own in itertools.groupby((p for p in pieces if len(p) > len(text)), lambda p: p[len(text)]):
                shorter = node[2]
                while shorter is not None and c not in shorter[0]:
                    shorter = shorter[2]
                shorter = root if shorter is None else shorter[0][c]
                longer = text + c
                ends = ((len(longer), longer), *shorter[1]) if len(longer) > 1 and longer in scores else shorter[1]
                node[0][c] = [{}, ends, shorter]
                below.append((node[0][c], longer, list(own)))
        level = below
    return root


class Vocabulary:
    """Pieces and scores of a SentencePiece model."""

    def __init__(
        self, scores: dict[str, float], ids: dict[str, int], contents: list[bytes], byte_ids: list[int], merges: bool, sparing: bool = False
    ):
        self.scores, self.ids, self.contents, self.byte_ids, self.merges = scores, ids, contents, byte_ids, merges
        self.longest = max(map(len, scores), default=1)
        self.unknown = min(scores.values(), default=0.0) - UNKNOWN_PENALTY
        inner = {c for p in scores if len(p) > 1 for c in p} - {SPACE}
        letters = "".join(re.escape(c) for c in sorted(inner)) or "\\0"
        self.cut = re.compile(f" *[{letters}]+| +|[^ {letters}]", re.DOTALL)
        self.remembered: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.sparing = sparing
        self.met = bytearray(MET if sparing else 0)
        self.lossy = False
        self.root = _automaton(scores)
        self.neighbours: dict[str, dict[str, bool]] = {}
        self.n_neighbours = 0

    def __getstate__(self):
        return self.scores, self.ids, self.contents, self.byte_ids, self.merges, self.sparing

    def __setstate__(self, state):
        self.__init__(*state)

    @classmethod
    def load(cls, path: str = MODEL, merges: bool = True, sparing: bool = False) -> Vocabulary:
        """Normal pieces and byte pieces of a model file; read on the driver."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        scores, ids, contents, byte_ids = {}, {}, [], [-1] * 256
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
                contents.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                contents.append(b"")
            else:
                scores[piece], ids[piece] = model.get_score(i), i
                contents.append(piece.replace(SPACE, " ").encode())
        if min(byte_ids) < 0:
            raise ValueError("the model has no byte pieces, so some texts could not be given back")
        return cls(scores, ids, contents, byte_ids, merges, sparing)

    def merged(self, text: str) -> list[str]:
        """A short text with the best-scored neighbours joined until none can be."""
        parts, score, none = list(text), self.scores.get, float("-inf")
        joined = [score(a + b, none) for a, b in zip(parts, parts[1:])]
        while joined:
            best = max(joined)
            if best == none:
                break
            at = joined.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del joined[at]
            if at:
                joined[at - 1] = score(parts[at - 1] + parts[at], none)
            if at < len(joined):
                joined[at] = score(parts[at] + parts[at + 1], none)
        return parts

    def _fit(self, left: str, right: str) -> bool:
        """Whether the merges leave these neighbours, or a first piece alone, as they are."""
        if self.n_neighbours >= REMEMBERED:
            self.neighbours, self.n_neighbours = {}, 0
        fits = self.merged(left + right) == ([left, right] if left else [right])
        self.neighbours.setdefault(right, {})[left] = fits
        self.n_neighbours += 1
        return fits

    def _admissible(self, text: str, base: int, ends: range, node: list, back: list[int], last: list[str]) -> list:
        """Appends where the last piece of the encoding of text[base:end] starts, and the piece, for the next ends.

        ``node`` is the longest beginning of a piece before them; gives the one after them.
        """
        for end in ends:
            chosen, piece = end - 1, text[end - 1]
            while (following := node[0].get(piece)) is None and node[2] is not None:
                node = node[2]
            node = following or node
            for size, ending in node[1]:
                if size <= end - base:
                    left = last[end - size - base]
                    fits = self.neighbours.get(ending, _NONE).get(left)
                    if fits or fits is None and self._fit(left, ending):
                        chosen, piece = end - size, ending
                        break
            back.append(chosen)
            last.append(piece)
        return node

    def _best(self, text: str, base: int, end: int, totals: list[float]) -> int:
        """Where the last piece of the best path to ``end`` starts; appends the path's score."""
        top, chosen = -1e300, end - 1
        for start in range(max(base, end - self.longest), end):
            score = self.scores.get(text[start:end], self.unknown if start == end - 1 else None)
            if score is not None and totals[start - base] + score > top:
                top, chosen = totals[start - base] + score, start
        totals.append(top)
        return chosen

    def stream(self, text: str) -> Iterator[int]:
        """Ids of a text, committed as soon as all paths agree."""
        base, at, node, back, last, totals = 0, 0, self.root, [0], [""], [0.0]
        while at < len(text):
            # on to the next place where the paths are followed back
            stop = min(-(-max(at + 1, base + 4 * self.longest) // self.longest) * self.longest, len(text))
            ends, at = range(at + 1, stop + 1), stop
            if self.merges:
                node = self._admissible(text, base, ends, node, back, last)
            else:
                back.extend(self._best(text, base, end, totals) for end in ends)
            if stop < len(text):
                met = self._meeting(back, base, stop)
                if met > base:
                    yield from self._path(text, back, base, met)
                    back, last, totals = back[met - base :], last[met - base :], totals[met - base :]
                    base = met
        yield from self._path(text, back, base, len(text))

    def _meeting(self, back: list[int], base: int, end: int) -> int:
        """The last boundary on the paths of all positions a later piece can start at."""
        live = set(range(end - self.longest + 1, end + 1))
        while len(live) > 1:
            latest = max(live)
            live.discard(latest)
            live.add(max(back[latest - base], base))
        return live.pop()

    def _path(self, text: str, back: list[int], base: int, end: int) -> list[int]:
        out: list[int] = []
        while end > base:
            start = back[end - base]
            number = self.ids.get(text[start:end])
            if number is None:
                out.extend(self.byte_ids[b] for b in reversed(text[start:end].encode("utf-8", "surrogatepass")))
            else:
                out.append(number)
            end = start
        return out[::-1]

    def _segment(self, segment: str) -> bytes:
        """Ids of the text between two certain boundaries. Two tables remember them; when one is
        full it becomes the older one, so that what is in use survives. A sparing vocabulary remembers
        only segments met a second time, in smaller tables: less memory for more searches."""
        known = self.remembered.get(segment) or self.older.get(segment)
        if known is None:
            if segment == SPACE:
                numbers = [self.byte_ids[b] for b in SPACE.encode()]
            else:
                numbers = list(self.stream(segment.replace(" ", SPACE)))
            known = array("i", numbers).tobytes()
            whole = b"".join(map(self.contents.__getitem__, numbers))
            self.lossy = self.lossy or whole != segment.encode("utf-8", "surrogatepass")
        if len(segment) <= 64:
            if self.sparing:
                slot = hash(segment) % MET
                if not self.met[slot] and segment not in self.older:
                    # a slot shared with another segment only remembers one too early
                    self.met[slot] = 1
                    return known
            if len(self.remembered) >= (SEGMENTS if self.sparing else REMEMBERED):
                self.older, self.remembered, self.met = self.remembered, {}, bytearray(len(self.met))
            self.remembered[segment] = known
        return known

    def encode(self, text: str | None) -> bytes:
        """Ids as packed 32-bit integers; null and empty texts have none."""
        if not text:
            return b""
        segments = self.cut.findall(" " + text)
        found = list(map(self.remembered.get, segments))
        if None in found:
            found = [f or self._segment(s) for f, s in zip(found, segments, strict=True)]
        return b"".join(found)

    def returns(self, text: str, ids: bytes) -> bool:
        """Whether decoding the ids gives the text. As long as every segment came back, so does what they make up."""
        return not self.lossy or self.decode(np.frombuffer(ids, np.int32)) == text

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids that :meth:`encode` made."""
        if not len(ids):
            return ""
        return b"".join(map(self.contents.__getitem__, ids.tolist()))[1:].decode("utf-8", "surrogatepass")


def _shared(spark: SparkSession, path: str, sparing: bool = False):
    """The vocabulary, as large as the model and never as the data, for all tasks."""
    return spark.sparkContext.broadcast(Vocabulary.load(path, sparing=sparing))


def encoded(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", model: str = MODEL, sparing: bool = False
) -> DataFrame:
    """doc_id, n_ids, ids and round_trip (decoding gives the text) of every row.

    Null and empty texts have no ids; their round trip is the empty text. Null and repeated ids are
    ordinary rows, texts of any length are encoded whole, and an empty table gives
    an empty result. Columns besides id and text play no part. ``sparing`` gives the same ids with
    less memory in the workers and more time.
    """
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")
    )
    shared = _shared(docs.sparkSession, model, sparing)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        for whole in batches:
            for row in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(row, SLICE_ROWS)
                texts = [t or "" for t in batch.column("text").to_pylist()]
                ids = [vocabulary.encode(t) for t in texts]
                same = [vocabulary.returns(t, i) for t, i in zip(texts, ids, strict=True)]
                counts = np.array([len(i) >> 2 for i in ids], np.int64)
                ends = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                values = pa.array(np.frombuffer(b"".join(ids), np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(counts), pa.ListArray.from_arrays(pa.array(ends), values), pa.array(same, pa.bool_())],
                    names=["doc_id", "n_ids", "ids", "round_trip"],
                )

    return rows.mapInArrow(encode, "doc_id long, n_ids long, ids array<int>, round_trip boolean")


def decoded(rows: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id and text from doc_id and ids; null ids count as none."""
    shared = _shared(rows.sparkSession, model)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [shared.value.decode(np.array(i or [], np.int32)) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(decode, "doc_id long, text string")
