"""Digest trees of stored tables (L10, D25): what differs between two is found without reading what doesn't."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Branches of a tree, and leaves of a branch.
BRANCHES, LEAVES = 512, 64
#: Rows of a stored page, the unit that is read or skipped.
PAGE_ROWS = 1_000


def _digest(columns: Sequence[str]) -> Column:
    return F.xxhash64(*[x for c in sorted(columns) for x in (F.col(c).isNull(), F.col(c))]).cast("decimal(38,0)")


@dataclass(frozen=True)
class DigestTree:
    """Rows in order of their leaf, a hash of their keys; each leaf, branch and the root has a count and a sum of row digests.

    Sums don't depend on order or partitions, and a parent's is its children's
    sum.  Comparing reads the branches, then the leaves of branches that differ,
    then the pages with rows of leaves that differ: leaves are stored in order, so
    page statistics spare the others.
    """

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    columns: tuple[str, ...]

    @classmethod
    def write(cls, df: DataFrame, keys: Sequence[str], path: str, *, branches: int = BRANCHES, leaves: int = LEAVES, page_rows: int = PAGE_ROWS) -> "DigestTree":
        spark = df.sparkSession
        rows = df.withColumn("_leaf", F.pmod(F.xxhash64(*keys), F.lit(branches * leaves)))
        files = int(spark.conf.get("spark.sql.shuffle.partitions"))
        rows.repartitionByRange(files, "_leaf").sortWithinPartitions("_leaf").write.option("parquet.page.row.count.limit", page_rows).parquet(f"{path}/rows")
        total = [F.sum("n").alias("n"), F.sum(F.col("digest").cast("decimal(38,0)")).cast("string").alias("digest")]
        each = spark.read.parquet(f"{path}/rows").groupBy("_leaf").agg(F.count("*").alias("n"), F.sum(_digest(df.columns)).cast("string").alias("digest"))
        each.withColumn("_branch", F.floor(F.col("_leaf") / leaves)).repartitionByRange(files, "_leaf").sortWithinPartitions("_leaf").write.parquet(f"{path}/leaves")
        spark.read.parquet(f"{path}/leaves").groupBy("_branch").agg(*total).coalesce(1).write.parquet(f"{path}/branches")  # a row for each branch
        return cls(spark, path, tuple(keys), tuple(df.columns))

    def root(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/branches").agg(F.sum("n").alias("n"), F.sum(F.col("digest").cast("decimal(38,0)")).cast("string").alias("digest"))

    def differing(self, other: "DigestTree") -> list[int]:
        """The numbers of the leaves that differ, from the branches that differ."""

        def apart(name: str, on: str, where: Column) -> list[int]:
            a, b = (t.spark.read.parquet(f"{t.path}/{name}").filter(where).select(on, F.struct("n", "digest").alias(side)) for t, side in ((self, "a"), (other, "b")))
            return sorted(r[on] for r in a.join(b, on, "full_outer").filter(~F.col("a").eqNullSafe(F.col("b"))).select(on).collect())  # at most a row for each branch, or leaf

        branches = apart("branches", "_branch", F.lit(True))
        return apart("leaves", "_leaf", F.col("_branch").isin(branches)) if branches else []

    def rows_of(self, leaves: Sequence[int]) -> DataFrame:
        """The rows of some leaves; equalities reach the scan, so pages without them are skipped."""
        where = reduce(Column.__or__, [F.col("_leaf") == leaf for leaf in leaves], F.lit(False)) if len(leaves) <= 200 else F.col("_leaf").isin(list(leaves))
        return self.spark.read.parquet(f"{self.path}/rows").filter(where).select(*self.columns)

    def changed(self, other: "DigestTree") -> DataFrame:
        """(side, *columns, n): rows that one side has n times more often than the other."""
        leaves = self.differing(other)
        a, b = (t.rows_of(leaves).withColumn("_sign", F.lit(sign)) for t, sign in ((self, 1), (other, -1)))
        counts = a.unionByName(b).groupBy(*self.columns).agg(F.sum("_sign").alias("n")).filter("n <> 0")
        return counts.select(F.when(F.col("n") > 0, "left").otherwise("right").alias("side"), *self.columns, F.abs("n").alias("n"))
