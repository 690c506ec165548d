"""Guards and metrics that are part of the plan (L2, A19, C3): nothing runs until the guarded result does, and a violation fails that action."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F


class GuardError(ValueError):
    """A guarded result had more rows than allowed."""


def ensured(df: DataFrame, test: Column, message: str | Column) -> DataFrame:
    """``df``, failing the action at the first row for which ``test`` isn't true; a filter, so no column pruning drops it."""
    text = F.lit(message) if isinstance(message, str) else message
    return df.filter(F.when(test, True).otherwise(F.raise_error(text).cast("boolean")))


def unique(df: DataFrame, keys: Sequence[str], what: str = "right side") -> DataFrame:
    """``df``, failing the action if a key has several rows.

    Keys are counted on the partitioning that a join on them needs anyway.
    """
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    named = F.concat(F.lit(f"{what}: key ("), *[x for k in keys for x in (F.coalesce(F.col(k).cast("string"), F.lit("null")), F.lit(", "))], F.lit(") is not unique"))
    return ensured(df.withColumn("_n", n), F.col("_n") == 1, named).drop("_n")


def present(df: DataFrame, keys: Sequence[str], what: str = "left side") -> DataFrame:
    """``df``, failing the action if a key is null."""
    return ensured(df, reduce(Column.__and__, [F.col(k).isNotNull() for k in keys]), f"{what}: null in {list(keys)}")


class Watched:
    """Row counts of a step's input and result, taken while the result is made.

    ``before(df)`` and ``after(df)`` give the frames to go on with; once an
    action has run over the result, ``multiplier()`` is its rows over the
    input's, and ``check`` refuses more than allowed.  Spark takes the metrics
    of a frame's first action only.
    """

    def __init__(self, name: str):
        self.name, self._before, self._after = name, Observation(f"{name} before"), Observation(f"{name} after")

    def before(self, df: DataFrame, *metrics: Column) -> DataFrame:
        return df.observe(self._before, F.count(F.lit(1)).alias("rows"), *metrics)

    def after(self, df: DataFrame, *metrics: Column) -> DataFrame:
        return df.observe(self._after, F.count(F.lit(1)).alias("rows"), *metrics)

    def metrics(self) -> dict[str, dict]:
        return {"before": self._before.get, "after": self._after.get}

    def multiplier(self) -> float | None:
        before, after = (m["rows"] for m in self.metrics().values())
        return after / before if before else None

    def check(self, most: float) -> None:
        if (found := self.multiplier()) is not None and found > most:
            raise GuardError(f"{self.name}: {found:.4f} rows for each row, at most {most} allowed")
