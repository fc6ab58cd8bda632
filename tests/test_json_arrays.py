"""Large JSON arrays in many tasks."""

from __future__ import annotations

import json
import random
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewarden.session import shared_folder
from tidewarden.sources import json_arrays
from tidewarden.sources.json_arrays import array_elements, read_large_arrays
from tidewarden.sources.requests import read_request_arrays

NASTY = ["plain", "} in text", "{[", 'quo"te', 'back\\', '\\"', '"}', "}\n{", "[]{}", "\\\\", "ünï🙂", "", '","source":"fake"}', "\\u007d"]


def request(rng, i):
    nested = json.dumps({"a": {"b": [1, {"c": rng.choice(NASTY)}]}})
    return {
        "source": f"s{i}", "type": rng.choice(NASTY), "subtype": rng.choice([None, *NASTY]), "payload": nested,
        "correlationId": rng.choice(NASTY), "tags": {rng.choice(NASTY): rng.choice(NASTY) for _ in range(rng.randint(0, 3))},
    }


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "600", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("indent", [None, 2])
def test_rows_equal_those_of_the_plain_reader(spark, small_splits, tmp_path, indent):
    rng = random.Random(indent)
    for name in range(3):
        rows = [request(rng, i) for i in range(40)]
        (tmp_path / f"{name}.json").write_text(json.dumps(rows, indent=indent, ensure_ascii=name == 1), encoding="utf-8")
    pieces = spark.read.option("lineSep", "}").text(str(tmp_path))
    assert pieces.rdd.getNumPartitions() > 20
    plain, made = read_request_arrays(spark, str(tmp_path)), read_large_arrays(spark, str(tmp_path))
    assert made.schema == plain.schema and made.count() == 120
    key = lambda r: json.dumps(r.asDict(), sort_keys=True, default=str)
    assert sorted(map(key, made.collect())) == sorted(map(key, plain.collect()))


@pytest.mark.parametrize(("text", "bodies"), [
    ("", []), ("  \n", []), ("[]", []), ("[ ]\n", []),
    ('{"a": {"b": 1}}', ['{"a": {"b": 1}}']),
    (' \n[ {} , {"a": []}\n]', ["{}", '{"a": []}']),
    ('[1, "x}y{", null, {"a": "}"}, [2], {"b": "]"}]', ['{"a": "}"}', '{"b": "]"}']),
    ('[{"a": {"b": {"c": {}}}}, {"d": [{"e": 1}, {"f": 2}]}]', ['{"a": {"b": {"c": {}}}}', '{"d": [{"e": 1}, {"f": 2}]}']),
])
def test_shapes(spark, tmp_path, text, bodies):
    (tmp_path / "x.json").write_text(text)
    found = array_elements(spark, str(tmp_path / "x.json")).orderBy("element").collect()
    assert [r.body for r in found] == bodies
    assert [r.element for r in found] == list(range(len(bodies)))


def test_one_file_is_read_by_many_tasks(spark, small_splits, tmp_path):
    rows = [{"source": f"s{i}", "payload": json.dumps({"v": "}" * (i % 7)})} for i in range(2000)]
    (tmp_path / "x.json").write_text(json.dumps(rows))
    made = array_elements(spark, str(tmp_path / "x.json"))
    assert made.count() == 2000
    assert made.agg(F.count_distinct("element")).first()[0] == 2000


def test_what_is_written_and_sorted_on_the_way_are_chunks_and_not_pieces(spark, tmp_path):
    rng = random.Random(7)
    rows = [request(rng, i) for i in range(6000)]
    (tmp_path / "x.json").write_text(json.dumps(rows), encoding="utf-8")
    folder = Path(shared_folder(spark).removeprefix("file:"))
    before = set(folder.glob("array-*"))
    plain, made = read_request_arrays(spark, str(tmp_path)), read_large_arrays(spark, str(tmp_path))
    key = lambda r: json.dumps(r.asDict(), sort_keys=True, default=str)
    assert sorted(map(key, made.collect())) == sorted(map(key, plain.collect()))
    written = sum(spark.read.parquet(str(f)).count() for f in set(folder.glob("array-*")) - before)
    assert 4 <= written < 200


@pytest.mark.parametrize("size", [1, 40, 5000])
def test_chunks_of_any_size_give_the_same_ends(monkeypatch, size):
    monkeypatch.setattr(json_arrays, "CHUNK", size)
    rng = random.Random(size)
    rows = [request(rng, i) for i in range(200)]
    text = json.dumps(rows, ensure_ascii=False)
    pieces = [p + "}" for p in text.split("}")]
    columns = [pa.array(["f"] * len(pieces)), pa.array([0] * len(pieces)), pa.array(pieces)]
    batch = pa.RecordBatch.from_arrays(columns, names=["file", "block", "piece"])
    cuts = [0, 3, 90, len(pieces)]
    chunks = [c.to_pylist()[0] for c in json_arrays._chunks(batch.slice(a, b - a) for a, b in zip(cuts[:-1], cuts[1:], strict=True))]
    for c in chunks:
        c["text"] = pa.decompress(c["text"], c["size"], "zstd", asbytes=True)
    assert b"".join(c["text"] for c in chunks).decode() == text + "}"
    assert [c["nth"] for c in chunks] == list(range(len(chunks))) and (len(chunks) == len(pieces) if size == 1 else len(chunks) < len(pieces))
    inside = depth = place = 0
    ends = []
    for c in chunks:
        ends += [place + int(e) for e in json_arrays._ends(c["text"], inside, depth, 1)]
        depth += c["inside"] if inside else c["outside"]
        inside, place = (inside + c["quotes"]) % 2, place + len(c["text"])
    whole = (text + "}").encode()
    assert [json.loads(whole[a:b].decode().lstrip("[, ")) for a, b in zip([0, *ends[:-1]], ends, strict=True)] == rows
