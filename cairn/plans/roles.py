"""The driver's tables in the engine's roles: subjects, encounters, coded events and a rule catalog.

``views`` gives the DataFrames, ``CTES`` the same relations as DuckDB SQL.
"""

from __future__ import annotations

from functools import lru_cache
from types import SimpleNamespace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.operators.rules import CodeRule, NumericRule

# (rule, domain, code_system, code, match_type, include)
RULES = [
    ("exact_v", "dx", "ICD-10-CM", "V12", "exact", True),
    ("exact_v", "dx", "LOINC", "V14", "exact", True),
    ("prefix_p", "dx", "ANY", "P1", "prefix", True),
    ("prefix_c", "dx", "ICD-10-CM", "C2", "prefix", True),
    ("regex_e", "px", "LOINC", "^E[0-9]$", "regex", True),
    ("wide", "px", "ANY", "V1", "prefix", True),
    ("off", "px", "ANY", "S1", "prefix", False),
]
UNITS = {"mmhg": ("mmHg", 1.0), "kpa": ("mmHg", 7.5006168270417), "": ("mmHg", 1.0)}
PRESSURE = NumericRule("pressure", exact=("view", "purchase"), low=45.0, high=200.0, units={"mmHg": 1.0, "kPa": 7.5006168270417})
GROUPS = {"money": CodeRule("money", ("purchase",)), "seen": CodeRule("seen", ("view", "click")), "p_any": CodeRule("p_any", (), ("p",)), "all_v": CodeRule("all_v", ("signup",), ("v", "e"))}


def tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names]


def views(spark: SparkSession, sf_dir: str) -> SimpleNamespace:
    customer, nation, region, orders, events = tables(spark, sf_dir, "customer", "nation", "region", "orders", "events")
    places = nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select("n_nationkey", F.col("n_name").alias("nation"), F.col("r_name").alias("region"))
    subj = customer.join(places, customer["c_nationkey"] == places["n_nationkey"]).select(
        F.col("c_custkey").alias("subject_id"), "region", "nation", F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"),
        (F.lit(1912) + F.col("c_custkey") % 97).cast("int").alias("birth_year"), F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M").alias("sex"),
    )
    days = ((F.col("o_orderkey") % 9) - 2).cast("int")
    enc = orders.select(
        F.col("o_orderkey").alias("encounter_id"), F.col("o_custkey").alias("subject_id"), F.col("o_orderdate").alias("start"),
        F.when(F.col("o_orderkey") % 17 != 0, F.col("o_orderdate") + F.make_dt_interval(days)).alias("end"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "EMER").when(F.col("o_orderpriority") == "2-HIGH", "IMP").when(F.col("o_orderpriority") == "3-MEDIUM", "AMB").otherwise("OTHER").alias("type"),
        F.col("o_totalprice").alias("cost"), F.col("o_orderstatus").alias("state"),
    )
    i = F.col("event_id")
    ev = events.select(
        "event_id", F.col("user_id").alias("subject_id"), (i % 400).alias("encounter_id"), "ts", F.col("event_type").alias("code"), "value", "props",
        F.concat(F.upper(F.substring("event_type", 1, 1)), (i % 30).cast("string")).alias("code2"),
        F.when(i % 3 == 0, "ICD-10-CM").when(i % 3 == 1, " icd10cm").otherwise("LOINC").alias("system"),
        F.when(i % 4 == 0, "mmHg").when(i % 4 == 1, "kPa").when(i % 4 == 2, F.lit(None)).otherwise("mg").alias("unit"),
        F.when(i % 23 == 0, "n/a").otherwise(F.col("value").cast("string")).alias("raw_value"),
        F.when(i % 29 == 0, "bad").when(i % 3 == 0, F.date_format("ts", "yyyyMMdd")).when(i % 3 == 1, F.date_format("ts", "yyyy-MM-dd")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("raw_ts"),
    )
    return SimpleNamespace(subj=subj, enc=enc, ev=ev, spark=spark, dir=sf_dir)


CTES = """subj AS (SELECT c_custkey AS subject_id, r_name AS region, n_name AS nation, c_mktsegment AS segment, c_acctbal AS balance,
    CAST(1912 + c_custkey % 97 AS INTEGER) AS birth_year, CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS sex
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
enc AS (SELECT o_orderkey AS encounter_id, o_custkey AS subject_id, o_orderdate AS start,
    CASE WHEN o_orderkey % 17 <> 0 THEN o_orderdate + to_days(CAST(o_orderkey % 9 - 2 AS INTEGER)) END AS "end",
    CASE o_orderpriority WHEN '1-URGENT' THEN 'EMER' WHEN '2-HIGH' THEN 'IMP' WHEN '3-MEDIUM' THEN 'AMB' ELSE 'OTHER' END AS type,
    o_totalprice AS cost, o_orderstatus AS state FROM orders),
ev AS (SELECT event_id, user_id AS subject_id, event_id % 400 AS encounter_id, ts, event_type AS code, value, props,
    upper(substr(event_type, 1, 1)) || CAST(event_id % 30 AS VARCHAR) AS code2,
    CASE event_id % 3 WHEN 0 THEN 'ICD-10-CM' WHEN 1 THEN ' icd10cm' ELSE 'LOINC' END AS system,
    CASE event_id % 4 WHEN 0 THEN 'mmHg' WHEN 1 THEN 'kPa' WHEN 2 THEN NULL ELSE 'mg' END AS unit,
    CASE WHEN event_id % 23 = 0 THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS raw_value,
    CASE WHEN event_id % 29 = 0 THEN 'bad' WHEN event_id % 3 = 0 THEN strftime(ts, '%Y%m%d') WHEN event_id % 3 = 1 THEN strftime(ts, '%Y-%m-%d') ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS raw_ts
  FROM events)"""

_rows = ", ".join(f"('{r}', '{d}', '{s}', '{c}', '{m}', {str(i).lower()})" for r, d, s, c, m, i in RULES)
RULES_CTE = f"rules AS (SELECT * FROM (VALUES {_rows}) AS t(rule, domain, code_system, code, match_type, include))"


def sql(body: str, *ctes: str) -> str:
    """A query over the role relations, plus any further CTEs."""
    return f"WITH {', '.join([CTES, *ctes])} {body}"


@lru_cache(maxsize=None)
def sql_rule_match(alias: str = "e") -> str:
    """The catalog's match test as one theta condition."""
    s, r = (f"regexp_replace(upper(trim({x})), '[^A-Z0-9]', '', 'g')" for x in (f"{alias}.system", "r.code_system"))
    c = f"upper(trim({alias}.code2))"
    return f"r.include AND ({r} = 'ANY' OR {r} = {s}) AND ((r.match_type = 'exact' AND {c} = r.code) OR (r.match_type = 'prefix' AND starts_with({c}, r.code)) OR (r.match_type = 'regex' AND regexp_matches({c}, r.code)))"
