"""Corpus preparation: a chain of stages over `documents`, each stored as Parquet and reread.

Stages take (spark, docs, sf_dir) and return a DataFrame; all but the last return the
columns of documents. Language ID and packing are not SQL, so ORACLE_SQL is None; tests
compare the stages with brute-force versions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkrec.llm import exact, language, mixing, packing, simhash
from sparkrec.session import durable, ship_package

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Texts whose likeliest language is less probable than this are rejected; four languages alike give 0.25.
LEAST_LANGUAGE = 0.3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no known language go: no letter, or no language with any confidence."""
    net = language.train(docs, F.lit(True))
    return docs.filter(language.accepted(net, LEAST_LANGUAGE))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the longest original stays, then the smallest id."""
    return exact.keep_one(docs, stored=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts with a similarity of 0.8 or more in word shingles of five, the smallest id stays."""
    return simhash.keep_one(docs, words=5, least=0.8, stored=True)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out, so that sources meet their shares."""
    return mixing.mix(docs, stored=True)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
