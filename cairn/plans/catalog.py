"""The engine's queries and their independent SQL forms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cairn.plans import bounded, clinical, composite, coverage, products, publishing, relational, screens
from cairn.plans.registry import ORACLES, QUERIES

_MODULES = (relational, composite, coverage, publishing, clinical, bounded, screens, products)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["op_K17_index_events"](spark, sf_dir)


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
