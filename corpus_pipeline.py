"""A corpus from raw documents to token ids: each stage calls one operator and is stored."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, mixing, quality, simhash, substrings
from tidemark.llm.common import documents, stored
from tidemark.llm.queries import VOCABULARY

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the repetition rules keep."""
    return quality.keep_good(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id."""
    return simhash.keep_first(docs)


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the passages of 13 words or more that a smaller id has."""
    return substrings.cleaned(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of sources takes them; those without a word are not in it."""
    return mixing.mixed_texts(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the token ids and of the text they stand for."""
    return bpe.digests(docs, VOCABULARY)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", good),
    ("near duplicates", distinct),
    ("repeated passages", unrepeated),
    ("mix of sources", mixed),
    ("token ids", encoded),
]

#: SQL has no 64-bit hash of the kind that the fingerprints need, and no byte-pair merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over ``documents``, each written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
