"""Explicit row order, of a table (E12) or inside each key (E9, K23), without a task that holds a table's or a key's rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairn import shared


def row_order(spark: SparkSession, df: DataFrame, keys: Sequence[str], name: str = "row_order") -> DataFrame:
    """1-based positions by a total order: ranges are ranked by themselves, then shifted by the ranges before them.

    Only one count for each range reaches the driver.
    """
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = shared.written(spark, df.repartitionByRange(n, *keys).withColumn("_range", F.spark_partition_id()), "ranges")  # so that a lost executor can't deal the rows anew
    counts = sorted((r["_range"], r["count"]) for r in ranged.groupBy("_range").count().collect())
    before, total = [], 0
    for number, count in counts:
        before.append((number, total))
        total += count
    shift = spark.createDataFrame(before, "_range int, _before long")
    w = Window.partitionBy("_range").orderBy(*keys)
    return ranged.join(F.broadcast(shift), "_range").withColumn(name, F.col("_before") + F.row_number().over(w)).drop("_range", "_before")


def ranked_in_ranges(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "rank") -> DataFrame:
    """As ``reduce.ranked``, where a key may hold a large share of all rows.

    Rows are dealt to ranges of (keys, order); each range's part of a key is
    ranked by itself, then shifted by the key's rows in the ranges before it.
    Only keys that span several ranges need a shift, fewer rows than twice the
    ranges, so that table is broadcast.  ``order`` must be total.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = shared.written(spark, df.repartitionByRange(n, *[F.asc_nulls_first(k) for k in keys], *order).withColumn("_range", F.spark_partition_id()), "ranges")
    parts = ranged.groupBy(*keys, "_range").agg(F.count("*").alias("_n"))
    ends = ranged.groupBy("_range").agg(F.min(F.struct(*keys)).alias("a"), F.max(F.struct(*keys)).alias("z"))
    edges = ends.select(F.explode(F.array("a", "z")).alias("e")).select("e.*").distinct()  # a key in several ranges ends or begins one
    same = [parts[k].eqNullSafe(edges[k]) for k in keys]
    w = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shift = parts.join(F.broadcast(edges), same, "left_semi").withColumn("_before", F.sum("_n").over(w)).filter("_before is not null")
    shift = shift.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_range").alias("_r"), "_before")
    own = F.row_number().over(Window.partitionBy(*keys, "_range").orderBy(*order))
    on = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys] + [F.col("_range") == F.col("_r")]
    out = ranged.withColumn("_own", own).join(F.broadcast(shift), on, "left")
    return out.withColumn(name, (F.col("_own") + F.coalesce("_before", F.lit(0))).cast("int")).drop("_own", "_before", "_range", "_r", *[f"_k_{k}" for k in keys])
