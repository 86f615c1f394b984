"""From raw documents to packed sequences: a corpus pipeline of the operators in ``bustrace.llm``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from bustrace.llm import exact, langid, minhash, mixing, packing
from bustrace.llm.queries import remainder
from bustrace.session import store

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go whose language can't be told: no letters, or ambiguous. Learned from the rows that are not held out."""
    model = langid.learn(docs.filter(remainder("doc_id", 3) != 1))
    return langid.drop_undetermined(docs, model)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return exact.drop_exact_copies(docs, keep="max")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: 0.8 of their five-word shingles are the same."""
    return minhash.drop_near_copies(docs, shingle_words=5)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target of their source takes them."""
    return mixing.mixed_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with the sequence and the place each of them takes."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language ID", language_id),
    ("exact dedup", exact_dedup),
    ("MinHash near-dedup", near_dedup),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", best_fit_packing),
]

#: Language models and tokens are beyond SQL; the tests compare the stages with plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
