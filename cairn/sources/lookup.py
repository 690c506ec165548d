"""Exact-key lookup on a bucketed store (C24): tables that meet by key without a shuffle."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn import shared
from cairn.operators import guards
from cairn.sources.writers import write_bucketed


@dataclass(frozen=True)
class KeyLookup:
    """A table bucketed and sorted by ``key`` in the shared folder.

    Reads by key of another store with as many buckets need no exchange and no
    sort on either side, however often they are done.  ``unique`` stores fail
    the first action that reads a repeated key.
    """

    spark: SparkSession
    table: str
    key: str
    buckets: int
    unique: bool

    @classmethod
    def write(cls, df: DataFrame, key: str, columns: Sequence[str], *, buckets: int = 256, unique: bool = False) -> "KeyLookup":
        spark = df.sparkSession
        name = f"cairn_lookup_{uuid.uuid4().hex}"
        rows = df.select(*dict.fromkeys([key, *columns])).repartition(buckets, key)  # a file for each bucket
        write_bucketed(rows, name, [key], buckets, path=shared.fresh_path(spark, "lookup"))
        return cls(spark, name, key, buckets, unique)

    def frame(self) -> DataFrame:
        """The stored rows; keys are compared inside their buckets."""
        rows = self.spark.table(self.table)
        return guards.unique(rows, [self.key], f"lookup of {self.key}") if self.unique else rows

    def rows_for(self, keys: DataFrame, column: str | None = None) -> DataFrame:
        """The stored rows of the keys in ``keys``; null keys ask for nothing."""
        asked = keys.select(F.col(column or self.key).alias(self.key)).filter(F.col(self.key).isNotNull())
        return self.frame().join(asked, self.key, "left_semi")

    def matching(self, df: DataFrame, column: str | None = None) -> DataFrame:
        """The rows of ``df`` whose key is stored."""
        asked = self.spark.table(self.table).select(F.col(self.key).alias("_stored"))
        return df.join(asked, F.col(column or self.key) == F.col("_stored"), "left_semi")

    def joined(self, other: "KeyLookup") -> DataFrame:
        """Rows of another store with this one's columns, where the key is in both."""
        return other.frame().join(self.frame().withColumnRenamed(self.key, other.key), other.key)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
