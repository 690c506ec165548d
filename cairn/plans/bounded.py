"""Queries over bounded and bucketed forms: lookups, filters, one-pass capture, digest trees, closed windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairn import shared
from cairn.functions import scalar
from cairn.operators import cohort, joins, membership, quality, rules
from cairn.plans.registry import query
from cairn.plans.roles import RULES, RULES_CTE, sql, sql_rule_match, tables


@query("op_C24_bucketed_store", sql("SELECT e.event_id, n.type, n.cost FROM ev e JOIN enc n USING (encounter_id)"))
def _(v):
    from cairn.sources.lookup import KeyLookup

    store = KeyLookup.write(v.enc, "encounter_id", ["type", "cost"], buckets=16, unique=True)
    asked = KeyLookup.write(v.ev, "encounter_id", ["event_id"], buckets=16)
    return store.joined(asked).select("event_id", "type", "cost")


@query("op_C24_rows_for_keys", sql("SELECT encounter_id, type FROM enc WHERE encounter_id IN (SELECT encounter_id FROM ev WHERE code = 'error')"))
def _(v):
    from cairn.sources.lookup import KeyLookup

    store = KeyLookup.write(v.enc, "encounter_id", ["type"], buckets=16, unique=True)
    return store.rows_for(v.ev.filter("code = 'error'")).select("encounter_id", "type")


@query("op_C25_hash_filter", sql("SELECT encounter_id, subject_id FROM enc WHERE encounter_id IN (SELECT encounter_id FROM ev WHERE value > 20)"))
def _(v):
    return membership.semi(v.enc, v.ev.filter("value > 20"), "encounter_id").select("encounter_id", "subject_id")


@query("op_C25_retention", sql("SELECT count(*) AS rows, count(*) FILTER (WHERE encounter_id IN (SELECT encounter_id FROM ev WHERE value > 20)) AS members, true AS none_lost FROM enc"))
def _(v):
    members = v.ev.filter("value > 20")
    found = membership.retention(v.enc, members, "encounter_id", membership.HashFilter.of(members, "encounter_id"))
    exact = joins.semi(v.enc, members, ["encounter_id"]).agg(F.count("*").alias("exact"))  # one row
    return found.join(F.broadcast(exact)).select("rows", "members", ((F.col("members") == F.col("exact")) & (F.col("over") >= 0) & (F.col("retained") <= F.col("rows"))).alias("none_lost"))


@query("op_B19_kept_and_left_out", sql("SELECT event_id FROM ev WHERE subject_id IN (SELECT subject_id FROM subj WHERE sex = 'F') AND encounter_id NOT IN (SELECT encounter_id FROM ev WHERE code = 'signup' AND value > 20)"))
def _(v):
    return joins.anti(joins.semi(v.ev, v.subj.filter("sex = 'F'"), ["subject_id"]), v.ev.filter("code = 'signup' AND value > 20"), ["encounter_id"]).select("event_id")


_CAPTURED = f"""m AS (SELECT e.event_id, r.rule, r.domain FROM ev e JOIN (SELECT DISTINCT * FROM rules) r ON {sql_rule_match()} GROUP BY ALL)"""


@query("op_K28_one_pass", sql("SELECT 'source' AS part, event_id AS item, CAST(NULL AS VARCHAR) AS detail, count(*) AS n FROM (SELECT DISTINCT event_id FROM m) GROUP BY 2 UNION ALL SELECT 'membership', event_id, rule, 1 FROM m UNION ALL SELECT 'observability', subject_id, strftime(ts, '%Y-%m-%d'), count(*) FROM ev GROUP BY 2, 3", RULES_CTE, _CAPTURED))
def _(v):
    out = cohort.capture(v.ev, RULES, shared.fresh_path(v.spark, "capture"), key="event_id", subject="subject_id", code="code2", system="system", ts="ts")
    source = out["source"].select(F.lit("source").alias("part"), F.col("event_id").alias("item"), F.lit(None).cast("string").alias("detail"), F.lit(1).cast("long").alias("n"))
    member = out["membership"].select(F.lit("membership").alias("part"), F.col("event_id").alias("item"), F.col("rule").alias("detail"), F.lit(1).cast("long").alias("n"))
    seen = out["observability"].groupBy("subject_id", "day").agg(F.sum("n").alias("n")).select(F.lit("observability").alias("part"), F.col("subject_id").alias("item"), F.date_format("day", "yyyy-MM-dd").alias("detail"), "n")
    return source.unionByName(member).unionByName(seen)


_CHANGED = "l_linenumber = 1 AND l_orderkey IN (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_linenumber = 1 ORDER BY 1 DESC LIMIT 3)"


@query("op_L10_digest_tree", f"SELECT side, l_orderkey, l_partkey, l_quantity, count(*) AS n FROM (SELECT 'left' AS side, l_orderkey, l_partkey, l_quantity FROM lineitem WHERE {_CHANGED} UNION ALL SELECT 'right', l_orderkey, l_partkey, l_quantity + 1 FROM lineitem WHERE {_CHANGED}) GROUP BY ALL")
def _(v):
    from cairn.sources.digests import DigestTree

    (li,) = tables(v.spark, v.dir, "lineitem")
    firsts = li.filter("l_linenumber = 1")
    last = firsts.select("l_orderkey").distinct().orderBy(F.desc("l_orderkey")).limit(3).withColumn("_changed", F.lit(1))
    other = li.join(F.broadcast(last), "l_orderkey", "left").withColumn("l_quantity", F.when((F.col("l_linenumber") == 1) & F.col("_changed").isNotNull(), F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))).drop("_changed")
    keys = ["l_orderkey", "l_linenumber"]
    trees = [DigestTree.write(df.select(*li.columns), keys, shared.fresh_path(v.spark, "tree")) for df in (li, other)]
    found = trees[0].changed(trees[1])
    return found.groupBy("side", "l_orderkey", "l_partkey", "l_quantity").agg(F.sum("n").alias("n"))


@query("op_I1_closed_windows", "SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 DAY FROM events) GROUP BY 1, 2")
def _(v):
    """Event-time windows in the append mode: only those that the watermark has closed are written."""
    from cairn.streaming.incremental import run_to, source, windowed

    (e,) = tables(v.spark, v.dir, "events")
    root = shared.fresh_path(v.spark, "windows")
    stream = source(v.spark, f"{v.dir}/events.parquet*", e.schema, files_per_batch=1_000_000).select("event_type", F.col("ts").cast("timestamp").alias("ts"))
    run_to(windowed(stream, ["event_type"], "ts", length="1 day", late="1 day"), f"{root}/out", f"{root}/checkpoint")
    return v.spark.read.parquet(f"{root}/out").select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "event_type", F.col("n_events").alias("n"))


# ---- catalogs that are tables -----------------------------------------------------------------------------------

_TABLE_RULES = """rt AS (SELECT DISTINCT p_brand AS rule, 'dx' AS domain, CASE p_size % 3 WHEN 0 THEN 'ANY' WHEN 1 THEN 'ICD-10-CM' ELSE 'LOINC' END AS code_system,
    ['V', 'P', 'E', 'C', 'S'][1 + p_size % 5] || CAST(p_partkey % 30 AS VARCHAR) AS code, CASE WHEN p_partkey % 7 = 0 THEN 'prefix' ELSE 'exact' END AS match_type, p_partkey % 13 <> 0 AS include FROM part),
catalog AS (SELECT rule, domain, code_system, code, match_type, bool_and(include) AS include FROM rt GROUP BY ALL)"""


def _table_rules(v):
    (p,) = tables(v.spark, v.dir, "part")
    code = F.concat(F.element_at(F.array(*map(F.lit, "VPECS")), (F.col("p_size") % 5 + 1)), (F.col("p_partkey") % 30).cast("string"))
    system = F.when(F.col("p_size") % 3 == 0, "ANY").when(F.col("p_size") % 3 == 1, "ICD-10-CM").otherwise("LOINC")
    rows = p.select(F.col("p_brand").alias("rule"), F.lit("dx").alias("domain"), system.alias("code_system"), code.alias("code"), F.when(F.col("p_partkey") % 7 == 0, "prefix").otherwise("exact").alias("match_type"), (F.col("p_partkey") % 13 != 0).alias("include"))
    return rules.catalog_from(rows.groupBy("rule", "domain", "code_system", "code", "match_type").agg(F.bool_and("include").alias("include")))


@query("op_A16_rule_table", sql("SELECT match_type, include, count(*) AS n, count(DISTINCT rule) AS sets FROM catalog GROUP BY 1, 2", _TABLE_RULES))
def _(v):
    return _table_rules(v).groupBy("match_type", "include").agg(F.count("*").alias("n"), F.count_distinct("rule").alias("sets"))


@query("op_A16_rule_table_matches", sql(f"SELECT r.rule, count(DISTINCT e.event_id) AS n FROM ev e JOIN catalog r ON {sql_rule_match()} GROUP BY 1", _TABLE_RULES))
def _(v):
    hits = rules.match_codes(v.ev, _table_rules(v), code="code2", system="system")
    return hits.groupBy("rule").agg(F.count("*").alias("n"))


@query("op_G6_merged_rule_table", sql("SELECT code, match_type, min(rule) AS rule, count(DISTINCT rule) AS merged FROM catalog WHERE include GROUP BY 1, 2", _TABLE_RULES))
def _(v):
    return _table_rules(v).filter("include").groupBy("code", "match_type").agg(F.min("rule").alias("rule"), F.count_distinct("rule").alias("merged"))


@query("op_K29_findings", sql(f"""SELECT rule, rows, matches, rows - matches AS duplicates, rule IN ('off', 'exact_v') AS required, CASE WHEN rows = 0 AND rule IN ('off', 'exact_v') THEN 'required_missing' WHEN rows = 0 THEN 'unmatched' WHEN rows > matches THEN 'duplicates' ELSE 'fine' END AS finding
    FROM (SELECT rule, coalesce(n, 0) AS rows, coalesce(d, 0) AS matches FROM (SELECT DISTINCT rule FROM rules) LEFT JOIN (SELECT rule, count(*) AS n, count(DISTINCT k) AS d FROM (SELECT r.rule, e.event_id, concat_ws('|', e.code2, e.system, CAST(e.subject_id AS VARCHAR)) AS k FROM ev e JOIN (SELECT DISTINCT * FROM rules) r ON {sql_rule_match()} GROUP BY ALL) GROUP BY 1) USING (rule))""", RULES_CTE))
def _(v):
    catalog = rules.catalog(v.spark, RULES)
    hits = rules.match_codes(v.ev, catalog, code="code2", system="system")
    return quality.terminology_qa(hits, catalog, scalar.record_id(F.col("code2"), F.col("system"), F.col("subject_id")), required=("off", "exact_v"))
