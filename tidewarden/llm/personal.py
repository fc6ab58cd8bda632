"""Personal data: fixed patterns, widened by bootstrapped contextual extraction.

The fixed patterns find the base spans, which are also the seeds. Every seed, and every
candidate (a number group or an @-word that no base span covers), is an instance with
the lexical patterns around it: the two words before, and the word before with the word
after. Patterns and instances form a graph that Spark scores in rounds: a pattern is as
sure of a kind as the mean score of its judged distinct instances, if at least
``LEAST_SEEDS`` of them are sure. Judged are seeds of any kind, candidates whose shape
rules the kind out (score 0) and candidates that have a score; open candidates say
nothing against a pattern. A candidate's score is the chance that one of its sure
patterns is right. Candidates that end at ``LEAST_SCORE`` or more, of a shape that the
kind allows, become spans of their own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import numbered, settled

#: The kinds in their order.
KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)

LEAST_SEEDS = 5
LEAST_CONFIDENCE = 0.8
LEAST_SCORE = 0.9
ROUNDS = 3
CONTEXT = 64
SLICE_ROWS = 512

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# The base patterns. A run of digits is entered at its start only, which
# finds the same spans: a search that fails there fails inside the run as well.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_GROUP = re.compile(r"[0-9](?:[\x20().-]{0,2}[0-9])+")
_TRIM = ".,;:!?()[]{}<>\"'"


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def passes_luhn(digits: str) -> bool:
    total = 0
    for place, c in enumerate(reversed(digits)):
        value = int(c) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Each @ is tried with the run of allowed characters before it, back to the last match."""
    found, done = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            done = match.end()
            found.append((start, done))
        at = text.find("@", match.end() if match else at + 1)
    return found


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, in order."""
    found = [(s, EMAIL, e) for s, e in emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            found.append((m.start(), IP, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _digits(m[0])
            if 14 <= len(digits) <= 19 and passes_luhn(digits):
                found.append((m.start(), CARD, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_digits(m[0])) <= 15:
                found.append((m.start(), PHONE, m.end()))
    return sorted(found)


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Number groups and @-words that touch no base span."""
    spans = [(m.start(), m.end()) for m in _GROUP.finditer(text) if m.end() - m.start() >= 7]
    at = text.find("@")
    while at >= 0:
        start, end = at, at + 1
        while start > 0 and not text[start - 1].isspace() and at - start < CONTEXT:
            start -= 1
        while end < len(text) and not text[end].isspace() and end - at < CONTEXT:
            end += 1
        spans.append((start, end))
        at = text.find("@", end)
    out, k = [], 0
    for s, e in sorted(spans):
        while k < len(base) and base[k][2] <= s:
            k += 1
        if not any(b[0] < e and s < b[2] for b in base[k : k + 4]):
            out.append((s, e))
    return out


def allowed_kinds(piece: str) -> list[int]:
    """The kinds a candidate may have by its shape."""
    if "@" in piece:
        return [EMAIL] if len(piece.strip(_TRIM)) >= 3 else []
    n = len(_digits(piece))
    return [k for k, fits in ((IP, piece.count(".") == 3), (CARD, 13 <= n <= 19), (PHONE, 7 <= n <= 15)) if fits]


def patterns(text: str, start: int, end: int) -> list[str]:
    before = [w.strip(_TRIM).lower() for w in text[max(0, start - CONTEXT) : start].split()[-2:]]
    after = [w.strip(_TRIM).lower() for w in text[end : end + CONTEXT].split()[:1]]
    out = []
    if len(before) == 2:
        out.append(f"{before[0]} {before[1]} _")
    if before and after:
        out.append(f"{before[-1]} _ {after[0]}")
    return out


_SPAN = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
_INSTANCE = pa.struct(
    [("start", pa.int32()), ("end", pa.int32()), ("kind", pa.int32()), ("allowed", pa.list_(pa.int32())), ("name", pa.string()), ("patterns", pa.list_(pa.string()))]
)
_SCHEMA = (
    "doc_id long, base array<struct<start: int, kind: int, end: int>>, instances array<struct<start: int, end: int,"
    " kind: int, allowed: array<int>, name: string, patterns: array<string>>>"
)


def _instance(text: str, start: int, end: int, kind: int) -> dict:
    piece = text[start:end]
    return {
        "start": start,
        "end": end,
        "kind": kind,
        "allowed": [] if kind >= 0 else allowed_kinds(piece),
        "name": piece.lower()[:256],
        "patterns": patterns(text, start, end),
    }


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for row in range(0, whole.num_rows, SLICE_ROWS):
            batch = whole.slice(row, SLICE_ROWS)
            base, instances = [], []
            for value in batch.column("text"):
                text = value.as_py() or ""
                spans = base_spans(text)
                base.append([{"start": s, "kind": k, "end": e} for s, k, e in spans])
                seeds = [_instance(text, s, e, k) for s, k, e in spans]
                others = [_instance(text, s, e, -1) for s, e in candidates(text, spans)]
                instances.append(seeds + others)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(base, pa.list_(_SPAN)), pa.array(instances, pa.list_(_INSTANCE))],
                names=["doc_id", "base", "instances"],
            )


def discovered(instances: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """name, kind and score of the candidates that sure patterns point to.

    ``instances`` has name, kind (-1 for candidates), allowed and patterns. Every
    round is written to the shared folder.
    """
    edges = settled(
        instances.select("name", F.explode("patterns").alias("pattern")).distinct(), "pii-edges"
    )
    sizes = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    seeds = instances.where("kind >= 0").select("name", "kind").distinct().withColumns({"score": F.lit(1.0), "seed": F.lit(True)})
    seeds = settled(seeds, "pii-seeds")
    fits = settled(
        instances.where("kind < 0")
        .select("name", F.explode("allowed").alias("kind"))
        .distinct()
        .join(seeds.select("name"), "name", "left_anti"),
        "pii-fits",
    )
    fitting = edges.join(fits, "name").groupBy("pattern", "kind").agg(F.count(F.lit(1)).alias("fitting"))
    open_before = settled(fitting, "pii-fitting")
    scores = seeds
    for _ in range(rounds):
        sure = (
            edges.join(scores, "name")
            .groupBy("pattern", "kind")
            .agg(
                F.sum("score").alias("mass"),
                F.count_if(F.col("score") >= LEAST_SCORE).alias("sure"),
                F.count_if(~F.col("seed")).alias("scored"),
            )
            .where(F.col("sure") >= LEAST_SEEDS)
            .join(sizes, "pattern")
            .join(open_before, ["pattern", "kind"], "left")
            .withColumn("judged", F.col("n") - F.coalesce("fitting", F.lit(0)) + F.col("scored"))
            .withColumn("confidence", F.col("mass") / (F.col("judged") + 1))
            .where(F.col("confidence") >= LEAST_CONFIDENCE)
            .select("pattern", "kind", "confidence")
        )
        found = (
            edges.join(sure, "pattern")
            .groupBy("name", "kind")
            .agg((1 - F.exp(F.sum(F.log(1 - F.col("confidence"))))).alias("score"))
            .join(fits, ["name", "kind"])
            .withColumn("seed", F.lit(False))
        )
        scores = settled(seeds.unionByName(found), "pii-scores")
    best = scores.join(fits, ["name", "kind"]).where(F.col("score") >= LEAST_SCORE)
    return best.groupBy("name").agg(
        F.max("score").alias("score"), F.max_by("kind", F.struct("score", -F.col("kind"))).alias("kind")
    )


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    one = F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"]))
    return F.array_join(one, ",")


def personal_spans(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, counts per kind, base_sha256, spans and n_added of every row.

    Counts and ``base_sha256`` are of the base patterns; ``spans`` holds those and the
    discovered ones as kind:start:end, in code points with exclusive end, by start and then
    in the order of ``KINDS``. Null texts are empty and have no span. Repeated and null ids
    are ordinary rows; what is discovered depends on distinct instances, not on how often
    a row occurs. An empty table gives an empty result. Other columns play no part.
    """
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")
    )
    scanned = numbered(rows.mapInArrow(_scan, _SCHEMA), "pii-scan")
    each = scanned.select("row_no", F.explode("instances").alias("i")).select("row_no", "i.*")
    added = (
        each.where("kind < 0")
        .select("row_no", "name", "start", "end")
        .join(discovered(each), "name")
        .groupBy("row_no")
        .agg(F.collect_list(F.struct("start", "kind", "end")).alias("added"))  # of one document
    )
    nothing = F.array().cast("array<struct<start: int, kind: int, end: int>>")
    joined = scanned.select("row_no", "doc_id", "base").join(added, "row_no", "left")
    every = F.array_sort(F.concat("base", F.coalesce("added", nothing)))

    def count(kind: int):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    return joined.select(
        "doc_id",
        *[count(k) for k in range(len(KINDS))],
        F.sha2(_written(F.col("base")), 256).alias("base_sha256"),
        _written(every).alias("spans"),
        F.size(F.coalesce("added", nothing)).cast("long").alias("n_added"),
    )
