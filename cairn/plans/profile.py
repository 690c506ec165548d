"""Guarded profile runs (K35): wall time, rows and the driver's peak memory of named queries."""

from __future__ import annotations

import resource
import time
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession


def profile(spark: SparkSession, sf_dir: str, queries: Mapping[str, Callable[[SparkSession, str], DataFrame]], names: Iterable[str] | None = None, *, most_seconds: float | None = None) -> DataFrame:
    """(name, seconds, rows, peak_mb, error): one row for each query; a slow or failing one does not end the run."""
    rows = []
    for name in names or queries:
        began, n, error = time.perf_counter(), None, None
        try:
            n = queries[name](spark, sf_dir).count()
        except Exception as e:  # noqa: BLE001  reported, and the others still run
            error = str(e).splitlines()[0][:300] if str(e) else type(e).__name__
        seconds = time.perf_counter() - began
        if error is None and most_seconds is not None and seconds > most_seconds:
            error = f"took more than {most_seconds} s"
        rows.append((name, round(seconds, 3), n, resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024, error))
    return spark.createDataFrame(rows, "name string, seconds double, rows long, peak_mb double, error string")


def plan_facts(df: DataFrame) -> dict[str, int]:
    """How many exchanges, broadcasts, nested loops and Python steps a plan has."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    words = {"exchanges": "Exchange hashpartitioning", "broadcasts": "BroadcastExchange", "nested_loops": "BroadcastNestedLoopJoin", "cartesian": "CartesianProduct", "python": "InArrow"}
    return {k: plan.count(w) for k, w in words.items()}
