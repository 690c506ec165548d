"""Corpus preparation: five stages over ``documents``, each one operator of ``cairn.llm``.

Every stage takes all documents its predecessor kept; its result is written as
Parquet and read again as the next one's input.  All but the last return the
columns of ``documents``, whatever further columns there are; the last returns
the packed pieces.  Rows are kept or dropped, never keys: a key that stands in
several rows, or a null one, decides nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm import common, decontaminate, packing, pii, quality, simhash

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _as_documents(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity the trusted text of their language allows.

    Null and empty texts score on their end mark alone; repeated rows are judged
    alike; without a trusted document, or in an empty table, nothing is dropped.
    """
    return _as_documents(quality.keep_good(spark, docs, common.table(spark, sf_dir, "labels")))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest doc_id, of each group of texts with similar sets of five-word shingles (0.8 or more).

    Null, empty and blank texts are one group; of exactly repeated rows one
    stays; rows with a null key all stay.
    """
    return _as_documents(simhash.keep_dissimilar(spark, docs))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Null and empty texts and items match nothing; repeated rows go or stay together.
    """
    return _as_documents(decontaminate.clean(spark, docs, common.table(spark, sf_dir, "benchmark")))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with surrogates for personal data, checked for collisions; n_chars follows the text.

    A null text and its n_chars are null; every row is returned.
    """
    return _as_documents(pii.without_personal_data(spark, docs.withColumn("n_chars", F.col("n_chars").cast("long")), length="n_chars"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences: each document's pieces with their places.

    A null or empty text is its end id alone; repeated rows are packed as often as they occur.
    """
    return packing.pack(spark, docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

#: Perplexities, greedy tilings, keyed permutations and tokenizers have no SQL form; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = common.table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = common.written(spark, docs, name)
    return docs
