"""Queries with SQL against it, and the pipeline stage by stage."""

from __future__ import annotations

import pytest

import corpus_pipeline
from tests.llm.corpus import FOLDER, HAVE_TABLES, LOWER, awkward, labels
from tests.llm.test_dedup import expected_components
from tests.oracle_check import compare, connect
from tidewarden.llm import registry

pytestmark = pytest.mark.skipif(not HAVE_TABLES, reason="no test tables")


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_against_sql(spark, name):
    assert compare(spark, connect(FOLDER), registry.QUERIES[name], registry.ORACLE_SQL[name], FOLDER) == ""


def test_stages(spark, tmp_path):
    """Each stage on what the one before kept, against its definition on those rows."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    toxic = {r.doc_id for r in registry.QUERIES["op3_toxicity"](spark, FOLDER).where("predicted = 1").collect()}
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        before = [(r.doc_id, r.text) for r in docs.collect()]
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / str(number)))
        after = spark.read.parquet(str(tmp_path / str(number)))
        assert after.columns == docs.columns
        left = [(r.doc_id, r.text) for r in after.collect()]
        if number == 0:
            assert {i for i, _ in left} == {i for i, _ in before} - toxic
        elif number == 1:
            best = {}
            for i, t in before:
                key = (t or "").translate(LOWER)
                best[key] = max(i, best.get(key, -1))
            assert sorted(i for i, _ in left) == sorted(best.values())
        elif number == 2:
            assert sorted(i for i, _ in left) == sorted({c for _, c in expected_components(before).values()})
        else:
            assert set(left) <= set(before) and len(left) > 0.9 * len(before)
            assert max(left.count(x) for x in set(left)) <= 2
        docs = after
    encoded = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert encoded.count() == docs.count() and encoded.where("NOT round_trip").count() == 0


def test_the_pipeline_is_a_query(spark):
    rows = registry.QUERIES["pipeline"](spark, FOLDER)
    assert rows.count() > 100 and rows.columns == ["doc_id", "n_ids", "ids", "round_trip"]


def test_stages_survive_awkward_rows(spark, tmp_path):
    docs = awkward(spark)
    folder = str(tmp_path)
    labels(spark, [(1, 1, 0), (10, 0, 1)]).write.parquet(f"{folder}/labels.parquet")
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    assert docs.count() > 0
