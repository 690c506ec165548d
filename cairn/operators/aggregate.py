"""Aggregations and set operations (D1..D27, E10, G1..G6)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def flag_pivot(df: DataFrame, keys: Sequence[str], column: str, values: Sequence[str]) -> DataFrame:
    """One boolean column per value: does any of the key's rows have it?"""
    return df.groupBy(*keys).agg(*[F.coalesce(F.bool_or(F.col(column) == v), F.lit(False)).alias(v) for v in values])


def max_where(value: Column | str, test: Column) -> Column:
    return F.max(F.when(test, F.col(value) if isinstance(value, str) else value))


def min_where(value: Column | str, test: Column) -> Column:
    return F.min(F.when(test, F.col(value) if isinstance(value, str) else value))


def distinct_where(value: str, test: Column) -> Column:
    return F.count_distinct(F.when(test, F.col(value)))


def tuple_distinct(*columns: str) -> Column:
    """Distinct tuples, those with nulls included."""
    return F.count_distinct(F.struct(*columns))


def observability(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Event counts and first moments by key, the null group kept."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_events"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))


def availability(parts: Mapping[str, DataFrame], key: str) -> DataFrame:
    """One row per key with a flag for each named frame that has it; one aggregation over the tagged union."""
    tagged = [df.select(F.col(key), F.lit(name).alias("_part")).distinct() for name, df in parts.items()]
    return flag_pivot(reduce(DataFrame.unionByName, tagged), [key], "_part", list(parts))


def duplicates(df: DataFrame, *columns: str) -> DataFrame:
    """rows, distinct record hashes and surplus rows (one null hash is no duplicate)."""
    h = F.sha2(F.concat_ws("\x1f", *columns), 256)
    return df.select(h.alias("h")).agg(F.count("*").alias("rows"), F.count_distinct("h").alias("distinct_rows"), F.max(F.col("h").isNull().cast("int")).alias("n")).select("rows", "distinct_rows", (F.col("rows") - F.col("distinct_rows") - F.coalesce("n", F.lit(0))).alias("duplicates"))


def surplus_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def conflicts(df: DataFrame, key: str, kind: str) -> DataFrame:
    """How many keys have each combination of more than one kind."""
    combos = df.groupBy(key).agg(F.array_join(F.sort_array(F.collect_set(kind)), "+").alias("kinds"), F.count_distinct(kind).alias("n")).filter("n > 1")
    return combos.groupBy("kinds").agg(F.count("*").alias("keys"))


def distinct_by_shards(df: DataFrame, keys: Sequence[str], value: Column, name: str, shards: int = 256) -> DataFrame:
    """Distinct values of each key: those of different shards of a hash are disjoint, so each is counted apart and the counts are summed.

    No task holds a key's values, however many a key has.
    """
    each = df.select(*keys, value.alias("_v")).filter("_v is not null").withColumn("_shard", F.pmod(F.xxhash64("_v"), F.lit(shards)))
    apart = each.groupBy(*keys, "_shard", "_v").agg(F.lit(1).alias("_one")).groupBy(*keys, "_shard").agg(F.count("*").alias("_n"))
    return apart.groupBy(*keys).agg(F.sum("_n").alias(name))


def histogram(df: DataFrame, value: str, low: float, high: float, bins: int) -> DataFrame:
    """Counts in equal bins over ``[low, high]``, the last one closed; values outside are left out."""
    width = (high - low) / bins
    number = F.least(F.floor((F.col(value) - low) / width), F.lit(bins - 1)).cast("long")
    return df.filter(F.col(value).between(low, high)).groupBy(number.alias("bin")).agg(F.count("*").alias("n"))


def _cell(v: Column) -> Column:
    """A number's place in a coarse order: its binary exponent and 12 bits below it; never out of order."""
    size = F.abs(v)
    power = F.greatest(F.floor(F.log2(size)), F.lit(-1022))
    cell = F.when(size == 0, F.lit(0)).otherwise((power + 1023) * 8192 + F.floor(size / F.pow(F.lit(2.0), power) * 4096)).cast("long")
    return F.when(v < 0, -cell).otherwise(cell)


def quartiles(df: DataFrame, value: str, *by: str) -> DataFrame:
    """Exact quartiles with linear interpolation, of the values that are not null.

    No task sees a group's values: equal ones are counted together first, cells
    of near ones are ranked in their group, and only the cells that hold a
    wanted rank are ranked by value.
    """
    on = list(by)
    v = F.col(value).cast("double")
    counted = df.filter(v.isNotNull()).groupBy(*on, (v + F.lit(0.0)).alias("_v")).agg(F.count("*").alias("_n")).withColumn("_cell", _cell(F.col("_v")))
    cells = counted.groupBy(*on, "_cell").agg(F.sum("_n").alias("_n"))
    whole = Window.partitionBy(*on)
    cells = cells.withColumn("_total", F.sum("_n").over(whole)).withColumn("_below", F.sum("_n").over(whole.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)))
    quarter = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(p).alias("p")) for i, p in enumerate((0.25, 0.5, 0.75), 1)]))
    at = (F.col("_total") - 1) * F.col("_q.p")
    wanted = cells.withColumn("_q", quarter).withColumn("_below", F.coalesce("_below", F.lit(0))).select(*on, "_cell", "_n", "_below", F.col("_q.i").alias("_i"), at.alias("_at"), F.explode(F.array(F.floor(at), F.ceil(at))).alias("_rank"))
    wanted = wanted.filter((F.col("_rank") >= F.col("_below")) & (F.col("_rank") < F.col("_below") + F.col("_n"))).drop("_n").distinct()
    inside = counted.join(wanted.select(*on, "_cell").distinct(), [*on, "_cell"], "left_semi")
    order = Window.partitionBy(*on, "_cell").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    inside = inside.withColumn("_first", F.coalesce(F.sum("_n").over(order), F.lit(0)))
    hit = inside.join(wanted, [*on, "_cell"]).filter((F.col("_rank") - F.col("_below") >= F.col("_first")) & (F.col("_rank") - F.col("_below") < F.col("_first") + F.col("_n")))
    each = hit.groupBy(*on, "_i", "_at").agg(F.min_by("_v", "_rank").alias("a"), F.max_by("_v", "_rank").alias("b"))
    each = each.withColumn("q", F.col("a") + (F.col("b") - F.col("a")) * (F.col("_at") - F.floor("_at")))
    return each.groupBy(*on).agg(*[F.max(F.when(F.col("_i") == i, F.col("q"))).alias(f"q{i}") for i in (1, 2, 3)])


def table_hash(df: DataFrame) -> DataFrame:
    """Order-free digest of a table: rows, columns and the sum of its rows' SHA-256 (the first 60 bits of each), columns in order of their names."""
    row = F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x1e")) for c in sorted(df.columns)]), 256)
    number = F.conv(F.substring(row, 1, 15), 16, 10).cast("decimal(38,0)")
    return df.agg(F.count("*").alias("rows"), F.lit(",".join(sorted(df.columns))).alias("columns"), F.coalesce(F.sum(number), F.lit(0)).cast("string").alias("digest"))


def coverage(parts: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """First and last day of each named source, in one aggregation over a tagged union."""
    rows = [df.select(F.lit(name).alias("source"), F.col(ts).alias("ts")) for name, (df, ts) in parts.items()]
    agg = reduce(DataFrame.unionByName, rows).groupBy("source").agg(F.min("ts").alias("a"), F.max("ts").alias("z"), F.count("ts").alias("n"))
    return agg.select("source", F.date_format("a", "yyyy-MM-dd").alias("first_day"), F.date_format("z", "yyyy-MM-dd").alias("last_day"), "n")


def unpivot_flags(df: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str = "name", value: str = "value") -> DataFrame:
    """Long form of many columns from one scan, where a union would scan once for each."""
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return df.select(*keys, F.expr(f"stack({len(columns)}, {pairs}) as ({name}, {value})"))


def flow(df: DataFrame, stages: Sequence[tuple[str, Column]]) -> DataFrame:
    """Cohort flow: rows at each cumulative stage, with shares of the previous and the first; one scan."""
    tests, running = [], None
    for _, test in stages:
        running = test if running is None else running & test
        tests.append(F.coalesce(running, F.lit(False)))
    counts = df.agg(*[F.count_if(t).alias(f"s{i}") for i, t in enumerate(tests)])
    long = counts.select(F.explode(F.array(*[F.struct(F.lit(i + 1).alias("stage_order"), F.lit(name).alias("stage"), F.col(f"s{i}").alias("n")) for i, (name, _) in enumerate(stages)])).alias("s")).select("s.*")
    w = Window.orderBy("stage_order")  # a row per stage
    previous, source = F.lag("n").over(w), F.first("n").over(w)
    pct = lambda part, whole: F.round(100.0 * F.try_divide(part.cast("double"), whole.cast("double")), 4)
    return long.select("stage_order", "stage", "n", pct(F.col("n"), previous).alias("pct_previous"), pct(F.col("n"), source).alias("pct_source"))


def completeness(expected: DataFrame, rules: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """For every expected element: rules, memberships and distinct sources, zero where there are none."""
    r = rules.groupBy(key).agg(F.count("*").alias("rules"))
    m = members.groupBy(key).agg(F.count("*").alias("memberships"), F.count_distinct("source_id").alias("sources"))
    out = expected.join(r, key, "left").join(m, key, "left")
    return out.select(key, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("rules", "memberships", "sources")])


def missingness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null counts and shares of each column, from one aggregation."""
    counts = df.agg(F.count("*").alias("total"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    long = counts.select("total", F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("missing")) for c in columns])).alias("s"))
    return long.select("s.column", "s.missing", "total", F.round(100.0 * F.try_divide(F.col("s.missing").cast("double"), F.col("total").cast("double")), 4).alias("pct_missing"))


def prevalence(df: DataFrame, flags: Sequence[str], *, evaluable: bool = False) -> DataFrame:
    """Share of rows with each tri-state flag true, over all rows or over those where it is known."""
    counts = df.agg(F.count("*").alias("total"), *[F.count_if(F.col(c)).alias(f"{c}_t") for c in flags], *[F.count(F.col(c)).alias(f"{c}_k") for c in flags])
    long = counts.select("total", F.explode(F.array(*[F.struct(F.lit(c).alias("flag"), F.col(f"{c}_t").alias("met"), F.col(f"{c}_k").alias("known")) for c in flags])).alias("s"))
    base = F.col("s.known") if evaluable else F.col("total")
    return long.select("s.flag", "s.met", base.alias("denominator"), F.round(100.0 * F.try_divide(F.col("s.met").cast("double"), base.cast("double")), 4).alias("pct"))
