"""Joins with guards, windows and as-of semantics (C1..C30).

Every join has an equality on its key, with time bounds as a residual, so none
plans as a nested loop over rows.  "Best match" joins reduce candidates with a
group limit or ``min_by`` before anything else is joined.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.operators import guards
from cairn.operators.reduce import keep_first


def guarded_left(left: DataFrame, right: DataFrame, keys: Sequence[str], *, strict: bool = True, require_keys: bool = False) -> DataFrame:
    """Many-to-one left join: a right side that isn't unique by key fails the action, so rows can't multiply."""
    if strict:
        right = guards.unique(right, keys)
        if require_keys:
            left = guards.present(left, keys)
    return left.join(right, list(keys), "left")


def replace_left(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One-to-one left join whose columns replace those of the same name."""
    same = [c for c in right.columns if c in left.columns and c not in keys]
    return left.drop(*same).join(right, list(keys), "left")


def left_all(base: DataFrame, parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Chain of left joins on one key; the base's partitioning is used by all of them."""
    return reduce(lambda a, b: a.join(b, list(keys), "left"), parts, base)


def semi(df: DataFrame, members: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(members.select(*keys).distinct(), list(keys), "left_semi")


def anti(df: DataFrame, members: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(members.select(*keys).distinct(), list(keys), "left_anti")


def semi_either(df: DataFrame, *tests: tuple[str, DataFrame, str]) -> DataFrame:
    """Rows that are a member by any of several keys: a flag join for each, never a nested loop."""
    flags = []
    out = df
    for i, (column, members, key) in enumerate(tests):
        flag = f"_in{i}"
        out = out.join(members.select(F.col(key).alias(column)).filter(F.col(column).isNotNull()).distinct().withColumn(flag, F.lit(True)), column, "left")
        flags.append(F.col(flag))
    return out.filter(F.coalesce(*flags, F.lit(False))).select(*df.columns)


def within(left: DataFrame, right: DataFrame, keys: Sequence[str], test: Column, how: str = "inner") -> DataFrame:
    """Equi-join with a residual test (interval, look-back and follow-up joins); name columns apart beforehand."""
    renamed = right.select([F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    on = reduce(Column.__and__, [left[k] == renamed[f"_r_{k}"] for k in keys]) & test
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def _seconds(ts: Column) -> Column:
    """Wall-clock seconds since 1970, never out of order."""
    ts = ts.cast("timestamp_ntz")
    return F.unix_date(F.to_date(ts)).cast("long") * 86_400 + F.hour(ts) * 3_600 + F.minute(ts) * 60 + F.second(ts)


def within_cells(left: DataFrame, right: DataFrame, keys: Sequence[str], *, start: Column, stop: Column, ts: str, test: Column, cell: int | None = None) -> DataFrame:
    """As ``within``, for a ``test`` that holds only where the right row's ``ts`` lies in the left row's [start, stop].

    Time is cut into cells of ``cell`` seconds.  A left row goes to each cell
    that its interval touches, a right row to its own, and cells are part of the
    join's key: a subject with a third of all rows is as many groups as it has
    cells, and rows far apart in time don't meet.  Where ``cell`` isn't given it is
    the mean length of the intervals (one aggregation over the left side), so
    that they touch two cells in the mean, however their lengths vary.
    Intervals without an end or beginning hold nothing.
    """
    spans = left.withColumn("_a", _seconds(start)).withColumn("_z", _seconds(stop)).filter("_a <= _z")
    if cell is None:
        cell = int(spans.agg(F.avg(F.col("_z") - F.col("_a"))).first()[0] or 0) + 1
    number = lambda s: F.floor(s / F.lit(cell)).cast("long")
    a = spans.withColumn("_cell", F.explode(F.sequence(number(F.col("_a")), number(F.col("_z"))))).drop("_a", "_z")
    b = right.filter(F.col(ts).isNotNull()).withColumn("_cell", number(_seconds(F.col(ts))))
    return within(a, b, [*keys, "_cell"], test).drop("_cell")


def as_of_forward(left: DataFrame, right: DataFrame, keys: Sequence[str], *, left_ts: str, right_ts: str, first_days: int, last_days: int, values: Sequence[str], tie: str, left_id: Sequence[str] = ()) -> DataFrame:
    """Each left row with the earliest right row in ``[+first, +last]`` days; ties go to the smallest ``tie``.

    No pairs are made: each left row stands as a marker at its first day among
    the right rows of its key, and takes the next right row, if that is not
    beyond its last day.  Left rows without a key or time get none, and
    ``left_id`` isn't needed, as no row is multiplied.
    """
    on = [f"_k{i}" for i in range(len(keys))]
    keyed = [F.col(k).alias(name) for k, name in zip(keys, on)]
    begin, end = (F.col(left_ts) + F.expr(f"INTERVAL '{d}' DAY") for d in (first_days, last_days))
    a = left.select(*keyed, begin.alias("_ts"), F.lit(0).alias("_side"), end.alias("_end"), F.struct(*left.columns).alias("_l"))
    b = right.filter(F.col(right_ts).isNotNull()).select(*keyed, F.col(right_ts).alias("_ts"), F.lit(1).alias("_side"), F.col(tie).alias("_tie"), F.struct(F.col(right_ts).alias("_at"), *[F.col(v).alias(f"_v{i}") for i, v in enumerate(values)]).alias("_r"))
    for k in on:  # null keys match nothing
        b = b.filter(F.col(k).isNotNull())
    # from late to early, so that the next row is the last one seen
    w = Window.partitionBy(*on).orderBy(F.desc("_ts"), F.desc("_side"), F.col("_tie").desc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = a.unionByName(b, allowMissingColumns=True).withColumn("_b", F.last("_r", ignorenulls=True).over(w)).filter("_l IS NOT NULL")
    hit = F.when(F.col("_b._at") <= F.col("_end"), F.col("_b"))
    return both.withColumn("_b", hit).select("_l.*", *[F.col(f"_b._v{i}").alias(v) for i, v in enumerate(values)])


def as_of_backward(left: DataFrame, right: DataFrame, keys: Sequence[str], *, left_ts: str, right_ts: str, values: Sequence[str], tie: str, strict: bool = True, left_id: Sequence[str] = ()) -> DataFrame:
    """Each left row with the latest right row before it (at or before it if not strict); ties go to the largest ``tie``.

    No pairs are made: both sides are one ordered sequence for each key, and
    each left row takes the last right row that it has seen.  Left rows without
    a key or time get none, and ``left_id`` isn't needed, as no row is multiplied.
    """
    seen = F.struct(*[F.col(v) for v in values])
    a = left.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(left_ts).alias("_ts"), F.lit(0 if strict else 1).alias("_side"), F.struct(*left.columns).alias("_l"))
    b = right.filter(F.col(right_ts).isNotNull()).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(right_ts).alias("_ts"), F.lit(1 if strict else 0).alias("_side"), F.col(tie).alias("_tie"), seen.alias("_r"))
    on = [f"_k{i}" for i in range(len(keys))]
    for k in on:  # null keys match nothing
        b = b.filter(F.col(k).isNotNull())
    w = Window.partitionBy(*on).orderBy("_ts", "_side", "_tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = a.unionByName(b, allowMissingColumns=True).withColumn("_b", F.last("_r", ignorenulls=True).over(w)).filter("_l IS NOT NULL")
    return both.select("_l.*", *[F.col(f"_b.{v}").alias(v) for v in values])


def pair_nearest(left: DataFrame, right: DataFrame, keys: Sequence[str], *, left_id: str, order: Sequence[Column], ranks: Sequence[Column], pair: Column | None = None) -> DataFrame:
    """Nearest partner by match level: ``ranks`` are tests from the best level down; ``order`` breaks ties inside one."""
    level = None
    for number, test in enumerate(ranks, 1):
        level = F.when(test, number) if level is None else level.when(test, number)
    joined = within(left, right, keys, pair if pair is not None else F.lit(True)).withColumn("level", level).filter("level is not null")
    return keep_first(joined, [left_id], [F.col("level").asc(), *order])


def pair_by_levels(left: DataFrame, right: DataFrame, keys: Sequence[str], *, left_id: str, levels: Sequence[tuple[Column, Column, Column]], order: Sequence[Column]) -> DataFrame:
    """As ``pair_nearest``, each level with an equality of its own, so that no subject's rows all meet.

    ``levels``, the best first: (a value of the left row, or an array of several;
    a value of the right row; the test of a pair that has them in common).
    """
    found = []
    for number, (mine, theirs, test) in enumerate(levels, 1):
        # an array is exploded: a row then lies in several buckets (neighbouring days)
        a = left.withColumn("_on", F.explode(mine) if "array" in left.select(mine).schema[0].dataType.simpleString() else mine)
        found.append(within(a, right.withColumn("_on", theirs), [*keys, "_on"], test).drop("_on").withColumn("level", F.lit(number)))
    return keep_first(reduce(DataFrame.unionByName, found), [left_id], [F.col("level").asc(), *order])


def multiplier(before: DataFrame, after: DataFrame) -> DataFrame:
    """(before, after, multiplier): the row counts of a join's left side and result, and their ratio."""
    both = before.select(F.lit(0).alias("after")).unionByName(after.select(F.lit(1).alias("after")))
    n = both.agg(F.count_if(F.col("after") == 0).alias("before"), F.count_if(F.col("after") == 1).alias("after"))
    return n.withColumn("multiplier", F.try_divide(F.col("after").cast("double"), F.col("before").cast("double")))


def merge_update(target: DataFrame, patch: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Update-from: patched columns take the patch's non-null values."""
    renamed = patch.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = target.join(renamed, list(keys), "left")
    return joined.select([F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c) if c in columns else F.col(c) for c in target.columns])


def compare_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Missing, extra and mismatched keys of two manifests."""
    a = left.select(*keys, F.col(value).alias("_a"), F.lit(True).alias("_l"))
    b = right.select(*keys, F.col(value).alias("_b"), F.lit(True).alias("_r"))
    kind = F.when(F.col("_r").isNull(), "missing").when(F.col("_l").isNull(), "extra").when(~F.col("_a").eqNullSafe(F.col("_b")), "mismatched").otherwise("same")
    return a.join(b, list(keys), "full_outer").select(*keys, kind.alias("outcome"))
