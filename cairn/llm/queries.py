"""The corpus operators as queries over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

import corpus_pipeline
from cairn.llm import ann, common, decontaminate, fim, hardneg, langid, minhash, packing, pii, quality, recount, secrets, simhash, store


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, common.table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(spark, common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


def op3_additive_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(spark, common.table(spark, sf_dir, "embeddings"))


def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = store.write_store(spark, common.table(spark, sf_dir, "documents"), common.fresh_path(spark, "store"))
    return store.read_digests(spark, path)


def op5_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.surrogates(spark, common.table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(spark, common.table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(spark, common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))


def op8_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recount.revise(common.table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(spark, common.table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(spark, common.table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(common.table(spark, sf_dir, "documents"))


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.groups(spark, common.table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hardneg.mine(spark, common.table(spark, sf_dir, "embeddings"))


#: Query name -> function; each applies one operator to its whole table.
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_decontamination": op2_decontamination,
    "op3_additive_ann": op3_additive_ann,
    "op4_token_store": op4_token_store,
    "op5_pii_surrogates": op5_pii_surrogates,
    "op6_secret_scan": op6_secret_scan,
    "op7_quality": op7_quality,
    "op8_edit_counts": op8_edit_counts,
    "op9_language_id": op9_language_id,
    "op10_simhash": op10_simhash,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_minhash": op12_minhash,
    "op13_hard_negatives": op13_hard_negatives,
}


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES["pipeline"] = pipeline


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    found = {"op6_secret_scan": secrets.oracle(), "op11_fill_in_middle": fim.oracle(), "op13_hard_negatives": hardneg.oracle()}
    if corpus_pipeline.ORACLE_SQL is not None:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
