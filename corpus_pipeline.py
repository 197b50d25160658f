"""A training corpus from ``documents``: the stages in order, each reading what the one before it wrote."""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import offerlens
from offerlens.llm import exact, mixing, near, queries, toxicity
from offerlens.llm.common import store

# tasks run wherever the driver was started from
cloudpickle.register_pickle_by_value(offerlens)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic, learned from the labels outside the held-out fold."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact.drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates: five-word shingles, similarity 0.8 or more."""
    return near.drop_near_duplicates(docs, size=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources at their target weights: a whole document once for each time it is drawn."""
    return mixing.mixture(docs, entire=True)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document of the mix, and what they decode to."""
    return queries.piece_digests(docs)


STAGES = [
    ("toxicity", clean),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mix),
    ("sentencepiece", encode),
]

#: the first stage trains a classifier and the fourth draws by hash
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each over all that its predecessor kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
