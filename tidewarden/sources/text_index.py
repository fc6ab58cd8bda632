"""A search index over stored event files: which stretches of three characters occur in which file.

The index is a table (gram, file) sorted by gram, written for the files that it does not
hold yet. A LIKE pattern is cut into its fixed stretches; a row can only match in a file that holds all their grams, so
only such files are opened, together with files that are not indexed yet, and the LIKE itself decides.
Looking up a handful of grams reads the few row groups of the index that hold them. Patterns without a
fixed stretch of three characters open every file.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.search import match_events
from ..session import written_once
from . import compaction, store
from .files import read_or_empty

GRAM = 3
#: Grams looked up for one pattern at most; fewer grams never lose a file.
MOST_GRAMS = 64
_INDEX = T.StructType([T.StructField("gram", T.StringType()), T.StructField("file", T.StringType())])
_FILES = T.StructType([T.StructField("file", T.StringType())])


class Opened(NamedTuple):
    """Files of the store: those that a search opens and how many there are."""

    files: list[str]
    stored: int


def fixed_stretches(text: str) -> list[str]:
    """The parts of a LIKE pattern between its wildcards, with escapes resolved."""
    stretches = [""]
    at = 0
    while at < len(text):
        c = text[at]
        if c == "\\" and at + 1 < len(text):
            stretches[-1] += text[at + 1]
            at += 2
            continue
        if c in "%_":
            stretches.append("")
        else:
            stretches[-1] += c
        at += 1
    return [s for s in stretches if s]


def grams_of(text: str) -> list[str]:
    """Grams that every match of the pattern holds, the same ones for the same pattern."""
    found = {s[i : i + GRAM] for s in fixed_stretches(text) for i in range(len(s) - GRAM + 1)}
    # characters outside the basic plane may count as two on the other side
    plain = sorted(g for g in found if all(ord(c) < 0x10000 for c in g))
    return plain[:: max(1, -(-len(plain) // MOST_GRAMS))]


def _grams(text: Column) -> Column:
    size = F.char_length(text)
    starts = F.sequence(F.lit(1), size - (GRAM - 1))
    return F.when(size >= GRAM, F.array_distinct(F.transform(starts, lambda i: F.substr(text, i, F.lit(GRAM)))))


def _number(path: str, name: str) -> str | None:
    found = re.search(rf"/{name}=([^/]+)/", path)
    return found[1] if found else None


def current_files(spark: SparkSession, root: str) -> list[str]:
    """The event files that readers of the store look at, by the newest manifest."""
    table = f"{root}/events"
    known = compaction.manifest(spark, table)
    days = {str(day): (known.version[day], known.up_to[day]) for day in known.version}

    def wanted(path: str) -> bool:
        version, up_to = days.get(_number(path, "event_date"), (None, -1))
        written = _number(path, "version")
        return int(written) == version if written else int(_number(path, "batch")) > up_to

    return sorted(p for part in compaction.stored_parts(spark, table, store.EVENT_ROWS) for p in part.inputFiles() if wanted(p))


def update_index(spark: SparkSession, root: str) -> int:
    """Add the files that are not indexed yet; returns their number.

    Call it after a batch or now and then: a file that is not indexed is always opened.
    """
    fresh = sorted(set(current_files(spark, root)) - _indexed(spark, root))
    if not fresh:
        return 0
    both = F.array_distinct(F.concat(*[F.coalesce(_grams(t), F.array().cast("array<string>")) for t in (F.col("payload"), F.to_json("tags"))]))
    rows = _rows_of(spark, root, fresh).select(F.input_file_name().alias("file"), F.explode(both).alias("gram"))
    found = rows.groupBy("gram", "file").agg(F.lit(1).alias("_n")).select("gram", "file")
    # one range of grams per file of the index, so a look-up opens few of them
    found.repartitionByRange("gram", "file").sortWithinPartitions("gram", "file").write.mode("append").parquet(f"{root}/text-index")
    spark.createDataFrame([(f,) for f in fresh], _FILES).coalesce(1).write.mode("append").parquet(f"{root}/text-index-files")
    return len(fresh)


def _indexed(spark: SparkSession, root: str) -> set[str]:
    """Names of the indexed files. They are listed last, so a broken run indexes its files again."""
    return {r.file for r in read_or_empty(spark, f"{root}/text-index-files", _FILES).distinct().collect()}


def _rows_of(spark: SparkSession, root: str, files: list[str]) -> DataFrame:
    """All copies of the events in some files, with ``event_date`` and ``batch``."""
    schema = T.StructType([*store.EVENT_ROWS.fields, T.StructField("event_date", T.DateType()), T.StructField("batch", T.LongType())])
    parts = []
    for base, own in (("events", [f for f in files if not _number(f, "version")]), ("events-compacted", [f for f in files if _number(f, "version")])):
        if own:
            parts.append(spark.read.schema(schema).option("basePath", f"{root}/{base}").parquet(*own).select(*schema.names))
    if not parts:
        return spark.createDataFrame([], schema)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def files_for(spark: SparkSession, root: str, text: str) -> Opened:
    """The files that can hold a match of ``%text%``."""
    files = current_files(spark, root)
    grams = grams_of(text)
    if not grams:
        return Opened(files, len(files))
    held = read_or_empty(spark, f"{root}/text-index", _INDEX).where(F.col("gram").isin(grams))
    enough = held.groupBy("file").agg(F.count_distinct("gram").alias("n")).where(F.col("n") == len(grams))
    matching = {r.file for r in enough.collect()}
    known = _indexed(spark, root)
    return Opened([f for f in files if f in matching or f not in known], len(files))


def indexed_matches(spark: SparkSession, root: str, text: str, **filters) -> DataFrame:
    """``search.match_events`` on the stored events in their latest state, opening only files that can match.

    Whether a hit has copies in other files is looked up by id alone; only where one has, whole
    rows are read to tell which copy stands, as in ``store.read_events``.
    """
    opened = files_for(spark, root, text)
    hits = match_events(_rows_of(spark, root, opened.files), text=text, **filters)
    every = store.read_events(spark, root, every_copy=True)
    ids = hits.select("id").distinct()
    newest = every.select("id").join(ids, "id", "left_semi").groupBy("id").agg(F.count(F.lit(1)).alias("_copies"))
    # written once: whether whole rows have to be read at all depends on it
    newest = written_once(newest, "hit-copies")
    last = hits.join(newest.where("_copies = 1").select("id"), "id", "left_semi")
    several = newest.where("_copies > 1").select("id")
    if several.isEmpty():
        return last
    # ids with several copies: whole rows, and the filters once more on the row that stands
    changed = match_events(store.current_events(every.join(several, "id", "left_semi")), text=text, **filters)
    return last.unionByName(changed)
