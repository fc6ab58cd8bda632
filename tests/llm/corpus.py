"""Small corpora with the awkward rows that every operator must survive."""

from __future__ import annotations

import re
from pathlib import Path

FOLDER = "/root/testdata/sf0.001"
HAVE_TABLES = Path(FOLDER).exists()
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, row string, kept string, size long"


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def awkward_rows() -> list[tuple]:
    """Nulls in every column, empty, blank and long texts, copies, ties and non-ASCII."""
    base = " ".join(f"word{i % 37}x{i}" for i in range(120))
    texts = [
        (1, base), (2, base), (2, base), (3, base.upper()), (4, base + " tail"),
        (5, None), (6, ""), (7, "  \n\t "), (8, "one two three"), (9, "ONE two three"),
        (None, base), (None, None), (10, "größe ñandú 日本語 🙂 " * 30), (11, "x" * 5000),
        (12, "a\nb\n" * 200), (13, "mail a.b@c.de and 10.0.0.1\ncall +1 (389) 555-5010 now"),
        (14, " ".join(f"w{i}" for i in range(20_000))), (15, "▁ under▁score  nbsp"),
    ]
    langs, sources = ["en", None, "de"], ["s1", None, "s2", "s1"]
    return [
        (i, t, langs[k % 3], sources[k % 4], None if t is None else len(t), "d", "r", "k", 1)
        for k, (i, t) in enumerate(texts)
    ]


def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")
