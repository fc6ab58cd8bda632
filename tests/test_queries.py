"""Every registered query against its independent SQL."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as contract
from tests.oracle_check import compare, connect
from tidewarden.plans.oracles import oracle_sql
from tidewarden.plans.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(oracle_sql())


def test_entry_finds_the_known_hits(spark):
    assert contract.entry(spark).count() == 5


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    difference = compare(
        spark, connection, QUERIES[name], oracle_sql()[name], FOLDER
    )
    assert difference == ""
