"""Named error conditions counted in one result (K30), and terminology quality (K29)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.operators.aggregate import distinct_by_shards


def validate(conditions: Mapping[str, DataFrame]) -> DataFrame:
    """(error, n): how many rows each condition's frame of offenders has, zero included."""
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("error"), "n") for name, df in conditions.items()]
    return reduce(DataFrame.unionByName, parts)


def fail_on_errors(validated: DataFrame) -> None:
    bad = validated.filter("n > 0").collect()  # a row per condition
    if bad:
        raise ValueError("; ".join(f"{r['error']}: {r['n']}" for r in bad))


def terminology_qa(hits: DataFrame, rules: DataFrame, record: Column, *, required: Sequence[str] = (), rule: str = "rule") -> DataFrame:
    """(rule, rows, matches, duplicates, required, finding) for each rule of the catalog, those without hits included.

    ``matches`` are distinct records, counted by shards, so no rule is one task;
    ``duplicates`` are the rows beyond them.  A required rule that matches nothing
    is a warning of its own.
    """
    each = hits.filter(F.col(rule).isNotNull())
    counts = each.groupBy(rule).agg(F.count("*").alias("rows")).join(distinct_by_shards(each, [rule], record, "matches"), rule, "left")
    out = rules.select(rule).distinct().join(counts, rule, "left").select(rule, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("rows", "matches")])
    out = out.withColumns({"duplicates": F.col("rows") - F.col("matches"), "required": F.col(rule).isin(*required)})
    none = F.col("rows") == 0
    return out.withColumn("finding", F.when(none & F.col("required"), "required_missing").when(none, "unmatched").when(F.col("duplicates") > 0, "duplicates").otherwise("fine"))
