"""Rule catalogs: code matching, numeric rules with audit, fan-out and unit normalisation.

Matching millions of rows against prefix and pattern rules never compares every
row with every rule: distinct (system, code) pairs meet exact rules in one
equi-join, and prefix rules in another, on their own beginnings of the lengths
that the catalog has; both may be broadcast or shuffled as their sizes ask.
Patterns have no such key: at most ``PATTERNS`` are tried on each distinct code.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions.scalar import finite, norm_code, number, system_key, to_celsius, to_fahrenheit
from cairn.operators import guards

PATTERNS = 1_000
ANY_SYSTEM = "ANY"
CATALOG_SCHEMA = "rule string, domain string, code_system string, code string, match_type string, include boolean"
MATCH_TYPES = ("exact", "prefix", "regex")


@dataclass(frozen=True)
class CodeRule:
    """A named set of exact codes and literal prefixes, for some code systems or any."""

    name: str
    exact: Sequence[str] = ()
    prefixes: Sequence[str] = ()
    systems: Sequence[str] = ()

    def mask(self, code: Column, system: Column | None = None) -> Column:
        c = norm_code(code)
        tests = ([c.isin(*[x.strip().upper() for x in self.exact])] if self.exact else []) + [c.startswith(p.strip().upper()) for p in self.prefixes]
        hit = reduce(Column.__or__, tests) if tests else F.lit(False)
        if self.systems and system is not None:
            hit = hit & system_key(system).isin(*[re.sub("[^A-Z0-9]", "", s.strip().upper()) for s in self.systems])
        return F.coalesce(hit, F.lit(False))


@dataclass(frozen=True)
class NumericRule(CodeRule):
    """A code rule with a range and a factor for each accepted unit."""

    low: float = float("-inf")
    high: float = float("inf")
    closed_low: bool = False
    closed_high: bool = False
    units: Mapping[str, float] = field(default_factory=dict)

    def in_range(self, v: Column) -> Column:
        low = v >= self.low if self.closed_low else v > self.low
        high = v <= self.high if self.closed_high else v < self.high
        return low & high

    def factor(self, unit: Column) -> Column:
        if not self.units:
            return F.lit(1.0)
        key = F.lower(F.trim(F.coalesce(unit, F.lit(""))))
        return F.create_map(*[F.lit(x) for k, v in self.units.items() for x in (k.strip().lower(), float(v))])[key]


def numeric_rule(df: DataFrame, rule: NumericRule, *, code: str, value: str, unit: str | None = None, system: str | None = None) -> DataFrame:
    """Rows whose code the rule considers, with ``value_std`` and ``outcome``: the first test that fails, or accepted."""
    rows = df.filter(CodeRule(rule.name, rule.exact, rule.prefixes).mask(F.col(code)))
    v = number(F.col(value)) * rule.factor(F.col(unit) if unit else F.lit(None).cast("string"))
    systems = rule.mask(F.col(code), F.col(system)) if system else F.lit(True)
    outcome = F.when(~systems, "rejected_system")
    if rule.units and unit:
        outcome = outcome.when(rule.factor(F.col(unit)).isNull(), "rejected_unit")
    outcome = outcome.when(~finite(number(F.col(value))), "rejected_non_numeric").when(~rule.in_range(v), "rejected_range").otherwise("accepted")
    return rows.withColumn("value_std", v).withColumn("outcome", outcome)


def audit(judged: DataFrame, *by: str) -> DataFrame:
    """Counts of a numeric rule's outcomes, in one aggregation."""
    kinds = ("accepted", "rejected_system", "rejected_unit", "rejected_non_numeric", "rejected_range")
    aggs = [F.count("*").alias("considered"), *[F.count_if(F.col("outcome") == k).alias(k) for k in kinds]]
    return judged.groupBy(*by).agg(*aggs) if by else judged.agg(*aggs)


def vital_rule(df: DataFrame, *, code: str, value: str, codes: Sequence[str], low: float, high: float, convert: str | None = None) -> DataFrame:
    """Rows of the codes whose value, after any temperature conversion, is in ``[low, high)``; single precision after the test."""
    v = number(F.col(value))
    v = {"celsius": to_celsius, "fahrenheit": to_fahrenheit}[convert](v) if convert else v
    rows = df.filter(CodeRule("", codes).mask(F.col(code))).withColumn("value_std", v)
    return rows.filter((F.col("value_std") >= low) & (F.col("value_std") < high)).withColumn("value_std", F.col("value_std").cast("float"))


def catalog(spark: SparkSession, rows: Iterable[tuple]) -> DataFrame:
    """A validated catalog from (rule, domain, code_system, code, match_type, include) rows."""
    rows = [tuple(r) for r in rows]
    seen = set()
    for rule, domain, system, code, match_type, include in rows:
        if match_type not in MATCH_TYPES:
            raise ValueError(f"{rule}: unknown match_type {match_type!r}")
        if match_type == "regex":
            spark.sparkContext._jvm.java.util.regex.Pattern.compile(code)  # the dialect that will run it
        if (key := (rule, system, code, match_type)) in seen:
            raise ValueError(f"duplicate rule {key}")
        seen.add(key)
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def catalog_of(spark: SparkSession, rules: Iterable[CodeRule], domain: str) -> DataFrame:
    """In-code rules as catalog rows; a rule without systems is for any."""
    rows = []
    for r in rules:
        for s in r.systems or (ANY_SYSTEM,):
            rows += [(r.name, domain, s, c, "exact", True) for c in r.exact] + [(r.name, domain, s, p, "prefix", True) for p in r.prefixes]
    return catalog(spark, rows)


def catalog_from(rows: DataFrame) -> DataFrame:
    """A catalog from a table (rule, domain, code_system, code, match_type, include), however large.

    It is checked where it is read: an unknown match type or a repeated rule
    fails the action that uses the catalog; empty codes and sets match nothing
    and are left out.
    """
    some = rows.select("rule", "domain", "code_system", F.trim("code").alias("code"), F.lower(F.trim("match_type")).alias("match_type"), F.coalesce("include", F.lit(True)).alias("include")).filter("rule <> '' AND code <> ''")
    known = guards.ensured(some, F.col("match_type").isin(*MATCH_TYPES), F.concat(F.lit("unknown match_type "), F.coalesce("match_type", F.lit("null"))))
    return guards.unique(known, ["rule", "code_system", "code", "match_type"], "catalog")


def match_codes(df: DataFrame, rules: DataFrame, *, code: str, system: str | None = None, how: str = "inner") -> DataFrame:
    """Theta join of rows and catalog: same system (or any) and exact, prefix or pattern match; adds ``rule``.

    Many-to-many: a row appears once for each rule name that matches it; ``how="left"`` keeps the rest with a null rule.
    """
    rules = rules.filter("include").select("rule", system_key(F.col("code_system")).alias("_rs"), F.when(F.col("match_type") == "regex", F.col("code")).otherwise(norm_code(F.col("code"))).alias("_rc"), "match_type")
    own = F.coalesce(system_key(F.col(system)), F.lit("\x00")) if system else F.lit(ANY_SYSTEM)  # a null system meets rules for any
    keys = df.select(norm_code(F.col(code)).alias("_c"), own.alias("_s")).filter("_c is not null").distinct()
    same = (F.col("_rs") == ANY_SYSTEM) | (F.col("_rs") == F.col("_s")) if system else F.lit(True)
    # configuration: the lengths of its prefixes, and its few patterns
    lengths = sorted(rules.filter("match_type = 'prefix'").agg(F.collect_set(F.length("_rc"))).first()[0])
    patterns = rules.filter("match_type = 'regex'").select("rule", "_rs", "_rc").distinct().limit(PATTERNS + 1).collect()
    if len(patterns) > PATTERNS:
        raise ValueError(f"more than {PATTERNS} patterns: each is tried on every code")
    mapped = keys.join(rules.filter("match_type = 'exact'"), F.col("_c") == F.col("_rc")).filter(same).select("_s", "_c", "rule")
    if lengths:
        begins = keys.withColumn("_n", F.explode(F.array(*[F.lit(n) for n in lengths]))).filter(F.col("_n") <= F.length("_c")).withColumn("_p", F.expr("left(_c, _n)"))
        hits = begins.join(rules.filter("match_type = 'prefix'"), F.col("_p") == F.col("_rc")).filter(same)
        mapped = mapped.unionByName(hits.select("_s", "_c", "rule"))
    if patterns:
        tests = [F.when(F.col("_c").rlike(r["_rc"]) & (F.lit(r["_rs"] == ANY_SYSTEM or not system) | (F.col("_s") == r["_rs"])), F.lit(r["rule"])) for r in patterns]
        mapped = mapped.unionByName(keys.select("_s", "_c", F.explode(F.array_compact(F.array(*tests))).alias("rule")))
    mapped = mapped.distinct()
    tagged = df.withColumn("_c", norm_code(F.col(code))).withColumn("_s", own)
    return tagged.join(mapped, ["_s", "_c"], how).drop("_s", "_c")


def predicate(rules: Iterable[tuple[str, str, str]], code: Column, system: Column) -> Column:
    """Constant predicate from (code_system, code, match_type) rows: IN sets by system, prefixes, patterns; false when empty."""
    exact: dict[str, list[str]] = {}
    tests: list[Column] = []
    c, s = norm_code(code), system_key(system)
    for rule_system, rule_code, match_type in rules:
        key = re.sub("[^A-Z0-9]", "", rule_system.strip().upper())
        if match_type == "exact":
            exact.setdefault(key, []).append(rule_code.strip().upper())
            continue
        hit = c.startswith(rule_code.strip().upper()) if match_type == "prefix" else c.rlike(rule_code)
        tests.append(hit if key == ANY_SYSTEM else (s == key) & hit)
    for key, codes in exact.items():
        tests.append(c.isin(*codes) if key == ANY_SYSTEM else (s == key) & c.isin(*codes))
    return F.coalesce(reduce(Column.__or__, tests), F.lit(False)) if tests else F.lit(False)


def normalise_units(df: DataFrame, *, value: str, unit: str, factors: Mapping[str, tuple[str, float]], low: float, high: float) -> DataFrame:
    """``value_std``, ``unit_std``, ``unit_known`` and ``plausible`` by a unit -> (standard unit, factor) table."""
    key = F.lower(F.trim(F.coalesce(F.col(unit), F.lit(""))))
    std, by = (F.create_map(*[F.lit(x) for k, v in factors.items() for x in (k, v[i])])[key] for i in (0, 1))
    v = number(F.col(value)) * by
    return df.withColumn("value_std", v).withColumn("unit_std", std).withColumn("unit_known", by.isNotNull()).withColumn("plausible", F.coalesce(v.between(low, high), F.lit(False)))


def split_groups(df: DataFrame, groups: Mapping[str, CodeRule], *, code: str) -> DataFrame:
    """Rows once for every group that matches (overlaps and repeats kept), tagged ``group``; distinct codes are classified once."""
    codes = df.select(code).filter(F.col(code).isNotNull()).distinct()
    tags = F.array_compact(F.array(*[F.when(rule.mask(F.col(code)), F.lit(name)) for name, rule in groups.items()]))
    return df.join(codes.select(code, F.explode(tags).alias("group")), code)


def first_reason(*ladder: tuple[Column, str], default: str = "included") -> tuple[Column, Column]:
    """(status, reason) of the first condition that holds."""
    reason = None
    for test, name in ladder:
        reason = F.when(test, name) if reason is None else reason.when(test, name)
    reason = reason if reason is not None else F.lit(None).cast("string")
    return F.when(reason.isNull(), default).otherwise("excluded"), reason
