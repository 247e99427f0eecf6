"""Corpus pipeline: documents through five of the training-data operators.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``. All stages but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import fertility, jaccard, mixing, packing, quality
from marquee.llm.common import read, stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    labels = read(spark, sf_dir, "labels")
    vectors = quality.word_vectors(docs)
    return quality.accepted(docs, quality.fitted(docs, labels, vectors), vectors)


def natural_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the basic counts and lie in their language's bands."""
    return fertility.accepted(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies: that with the smallest id."""
    return jaccard.first_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of its source takes it."""
    return mixing.repeat_rows(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all packed sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", good_quality),
    ("quality rules", natural_text),
    ("n-gram Jaccard join", one_of_each),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_windows),
]

#: fitted and sampled stages: SQL can't express them
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-").lower())
    return docs
