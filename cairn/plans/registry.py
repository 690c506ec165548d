"""A query with its independent SQL form, registered under one name."""

from __future__ import annotations

from collections.abc import Callable
from types import SimpleNamespace

from pyspark.sql import DataFrame, SparkSession

from cairn.plans import roles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register ``f(views) -> DataFrame`` as ``f(spark, sf_dir)``."""

    def add(f: Callable[[SimpleNamespace], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is there already")
        QUERIES[name] = lambda spark, sf_dir: f(roles.views(spark, sf_dir))
        if oracle is not None:
            ORACLES[name] = oracle
        return f

    return add
