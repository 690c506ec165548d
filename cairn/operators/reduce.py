"""Deterministic reductions to one row per key (E1..E17, D4, D12).

Every order is total: callers pass tie-breaks, and nulls sort last in both
directions.  ``row_number() = 1`` filters get Spark's group limit, so each task
keeps one row per key before the shuffle; single values use ``max_by``, which
needs no sort at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Order = Sequence[Column]


def asc(name: str) -> Column:
    return F.col(name).asc_nulls_last()


def desc(name: str) -> Column:
    return F.col(name).desc_nulls_last()


def ranked(df: DataFrame, keys: Sequence[str], order: Order, name: str = "rank") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def keep_first(df: DataFrame, keys: Sequence[str], order: Order) -> DataFrame:
    return ranked(df, keys, order, "_rank").filter("_rank = 1").drop("_rank")


def top_k(df: DataFrame, keys: Sequence[str], order: Order, k: int) -> DataFrame:
    return ranked(df, keys, order).filter(F.col("rank") <= k)


def two_level(df: DataFrame, inner: Sequence[str], outer: Sequence[str], inner_order: Order, outer_order: Order) -> DataFrame:
    """Best row per inner key (an encounter), then best of those per outer key (a patient)."""
    return keep_first(keep_first(df, inner, inner_order), outer, outer_order)


def two_level_first(df: DataFrame, *, patient: str, encounter: str, ts: str, tie: str, more: Order = ()) -> DataFrame:
    return two_level(df, [patient, encounter], [patient], [asc(ts), *more, asc(tie)], [asc(ts), asc(encounter), *more, asc(tie)])


def two_level_last(df: DataFrame, *, patient: str, encounter: str, ts: str, tie: str) -> DataFrame:
    """Latest; on equal times the smallest encounter, then the latest row."""
    return two_level(df, [patient, encounter], [patient], [desc(ts), desc(tie)], [desc(ts), asc(encounter), desc(tie)])


def two_level_highest(df: DataFrame, *, patient: str, encounter: str, value: str, tie: str) -> DataFrame:
    """Highest; on equal values the largest encounter, then the earliest row."""
    return two_level(df, [patient, encounter], [patient], [desc(value), asc(tie)], [desc(value), desc(encounter), asc(tie)])


def first_value(value: str | Column, *order: str, where: Column | None = None) -> Column:
    """Aggregate: the value at the smallest (order...), nulls kept as values; ``where`` filters rows.

    Null orders come last: each is led by whether it is null.
    """
    key = F.struct(*[c for o in order for c in (F.col(o).isNull().alias(f"{o}_null"), F.col(o))])
    return F.min_by(value, key if where is None else F.when(where, key))


def last_value(value: str | Column, *order: str, where: Column | None = None) -> Column:
    """Aggregate: the value at the largest (order...), null orders last here too."""
    key = F.struct(*[c for o in order for c in (F.col(o).isNotNull().alias(f"{o}_known"), F.col(o))])
    return F.max_by(value, key if where is None else F.when(where, key))


def by_priority(value: str, ranks: dict[str, int], order: str) -> Column:
    """Aggregate: the value with the highest rank; equal ranks go to the earliest ``order``."""
    rank = F.create_map(*[F.lit(x) for kv in ranks.items() for x in kv])[F.col(value)]
    return F.max_by(value, F.struct(F.coalesce(rank, F.lit(0)).alias("r"), (-F.col(order)).alias("o")))
