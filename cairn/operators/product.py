"""Validation of a stored product against its contract (K30): every condition counted, none stops the others.

A product is a set of named tables.  Conditions on names and schemas need no
job; those on rows are aggregates of one result, one pass for each table where
they can share it, and joins by key elsewhere.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.operators import aggregate


@dataclass(frozen=True)
class Contract:
    """What a product must be.

    ``schemas``: a table's ordered columns with types, as ``name type, ...``.
    ``sources``: the logical domain of each source table.  ``manifest``: what the one
    row of the manifest must say.  ``outputs``: the keys of all outputs.
    ``all_rows``: domains whose rows need no membership.
    """

    required: Sequence[str]
    sources: Mapping[str, str]
    schemas: Mapping[str, str] = field(default_factory=dict)
    manifest: Mapping[str, str] = field(default_factory=dict)
    outputs: Sequence[str] = ()
    output_columns: Sequence[str] = ()
    all_rows: Sequence[str] = ("encounter", "patient")
    not_empty: Sequence[str] = ("labs", "encounter", "patient")


def _ordered(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)


def _rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def _long(df: DataFrame, names: Mapping[str, Column]) -> DataFrame:
    """One pass: (error, n) for each named aggregate."""
    counts = df.agg(*[F.coalesce(c, F.lit(0)).cast("long").alias(f"_{i}") for i, c in enumerate(names.values())])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(name).alias("error"), F.col(f"_{i}").alias("n")) for i, name in enumerate(names)])))


def _named(error: str, n: DataFrame) -> DataFrame:
    return n.select(F.lit(error).alias("error"), F.col("n").cast("long").alias("n"))


def validate(spark: SparkSession, tables: Mapping[str, DataFrame], contract: Contract) -> DataFrame:
    """(error, n): how often each condition is violated, zeros included.

    Tables: ``manifest``; ``observations`` (output_key, category, label, ...);
    ``memberships`` of observations; ``output_manifest`` (output_key, row_count,
    digest, columns); the sources (record_id, domain, source_file, row_number,
    ...); ``element_catalog`` (element_id, element_kind), ``element_rule`` (element_id,
    include), ``element_membership`` (element_id, record_id, domain, include) and
    ``inventory`` (path, domain).  What a missing table would tell is left out.
    """
    there = set(tables)
    fixed = [("missing_tables", sum(name not in there for name in contract.required))]
    fixed += [(f"schema.{name}", int(_ordered(tables[name]) != expected)) for name, expected in contract.schemas.items() if name in there]
    out = [spark.createDataFrame(fixed, "error string, n long")]
    has = lambda *names: all(n in there for n in names)
    if has("manifest"):
        wrong = {f"manifest.{name}": F.count_if(~F.col(name).eqNullSafe(F.lit(value))) for name, value in contract.manifest.items()}
        out.append(_long(tables["manifest"], {"manifest.not_single": (F.count("*") != 1).cast("long"), **wrong}))
    if has("observations"):
        seen = tables["observations"]
        out.append(_long(seen, {"label_disagrees": F.count_if(~F.coalesce("label", F.lit("")).eqNullSafe(F.col("category"))), "unknown_output_keys": F.count_if(~F.col("output_key").isin(*contract.outputs))}))
        if has("memberships"):
            both = seen.select(F.lit(1).alias("_d")).unionByName(tables["memberships"].select(F.lit(-1).alias("_d")))
            out.append(_named("memberships_not_reconciled", both.agg(F.abs(F.coalesce(F.sum("_d"), F.lit(0))).alias("n"))))
        if has("output_manifest"):
            out += _outputs(spark, seen, tables["output_manifest"], contract)
    sources = {name: tables[name] for name in contract.sources if name in there}
    out += [_source(df, name, contract) for name, df in sources.items()]
    if sources:
        every = reduce(DataFrame.unionByName, [df.select("record_id", F.lit(contract.sources[name]).alias("own")) for name, df in sources.items()])
        out.append(_named("duplicate_record_ids", aggregate.surplus_keys(every, ["record_id"]).agg(F.sum(F.col("n") - 1).alias("n")).select(F.coalesce("n", F.lit(0)).alias("n"))))
        if has("element_membership"):
            member = tables["element_membership"]
            same = [F.col("record_id") == F.col("_id"), F.col("own") == F.col("_domain")]
            known = every.distinct().select(F.col("record_id").alias("_id"), F.col("own").alias("_domain"))
            out.append(_named("orphan_memberships", _rows(member.withColumnRenamed("domain", "own").join(known, same, "left_anti"))))
            held = member.filter("include").select(F.col("record_id").alias("_id"), F.col("domain").alias("_domain")).distinct()
            alone = every.filter(~F.col("own").isin(*contract.all_rows)).join(held, same, "left_anti").groupBy("own").agg(F.count("*").alias("n"))
            domains = spark.createDataFrame([(d,) for d in dict.fromkeys(contract.sources[s] for s in sources) if d not in contract.all_rows], "own string")
            out.append(domains.join(alone, "own", "left").select(F.concat(F.lit("retained_without_membership."), "own").alias("error"), F.coalesce("n", F.lit(0)).alias("n")))
    if has("inventory"):
        out.append(_named("files_in_several_domains", _rows(tables["inventory"].groupBy("path").agg(F.count_distinct("domain").alias("d")).filter("d > 1"))))
    if has("element_catalog"):
        catalog = tables["element_catalog"]
        out.append(_named("duplicate_elements", _rows(aggregate.surplus_keys(catalog, ["element_id"]))))
        if has("element_membership"):
            out.append(_named("unknown_elements", _rows(tables["element_membership"].join(catalog.select("element_id").distinct(), "element_id", "left_anti"))))
        if has("element_rule"):
            included = tables["element_rule"].filter("include").select("element_id").distinct()
            out.append(_named("elements_without_included_rule", _rows(catalog.filter("element_kind = 'source_concept'").select("element_id").distinct().join(included, "element_id", "left_anti"))))
    return reduce(DataFrame.unionByName, out)


def _source(df: DataFrame, name: str, contract: Contract) -> DataFrame:
    """One pass over a source table: provenance, domain, and whether it may be empty."""
    lost = reduce(Column.__or__, [F.col(c).isNull() for c in ("record_id", "source_file", "row_number")])
    domain = contract.sources[name]
    checks = {f"without_provenance.{name}": F.count_if(lost), f"wrong_domain.{name}": F.count_if(~F.col("domain").eqNullSafe(F.lit(domain)))}
    if domain in contract.not_empty:
        checks[f"empty.{name}"] = (F.count("*") == 0).cast("long")
    return _long(df, checks)


def _outputs(spark: SparkSession, seen: DataFrame, manifest: DataFrame, contract: Contract) -> list[DataFrame]:
    """The manifest of outputs against the outputs: keys, rows, columns and order-free digests."""
    keys = spark.createDataFrame([(k,) for k in contract.outputs], "output_key string")
    listed = manifest.groupBy("output_key").agg(F.count("*").alias("times"), F.max("row_count").alias("row_count"), F.max("digest").alias("stored"), F.max("columns").alias("columns"))
    row = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\x1e")) for c in contract.output_columns]).cast("decimal(38,0)")
    made = seen.groupBy("output_key").agg(F.count("*").alias("rows"), F.sum(row).cast("string").alias("digest"))
    both = keys.withColumn("_wanted", F.lit(True)).join(listed, "output_key", "full_outer").join(made, "output_key", "left")
    fine = F.col("_wanted").isNotNull() & (F.col("times") == 1)
    return [_long(both, {
        "output_manifest.incomplete": F.count_if(~F.coalesce(fine, F.lit(False))),
        "output_manifest.row_count": F.count_if(fine & ~F.coalesce("rows", F.lit(0)).eqNullSafe(F.col("row_count"))),
        "output_manifest.columns": F.count_if(fine & ~F.col("columns").eqNullSafe(F.lit(",".join(contract.output_columns)))),
        "output_manifest.digest": F.count_if(fine & F.col("stored").isNotNull() & ~F.col("digest").eqNullSafe(F.col("stored"))),
    })]
