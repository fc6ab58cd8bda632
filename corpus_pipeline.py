"""A corpus pipeline of five stages over the table ``documents``.

Toxic documents go, then exact copies, then near copies; the sources that are left are
mixed to their target weights, and the mix is encoded. Every stage works on all rows
of the one before, which are written as Parquet in between.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewarden.llm import exact, mixing, near, pieces, toxicity
from tidewarden.session import fresh_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled examples do not reject."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of equal texts, the one with the largest id."""
    return exact.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the one with the smallest id."""
    return near.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, as often as the mix of sources takes them."""
    return mixing.mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document of the mix; executors that ran the stages before have little memory left."""
    return pieces.encoded(docs, sparing=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("source mix", mix_sources),
    ("pieces", encode),
]

#: SQL cannot express the nearest examples, the permutations or the piece search.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; the rows of the last one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        folder = fresh_folder(spark, f"stage-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
