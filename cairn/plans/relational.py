"""Queries over single operators: scans, predicates, joins, aggregates, windows, sorts, sets, scalars."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairn.functions import scalar, temporal
from cairn.operators import aggregate, frequent, guards, joins, order, reduce, rules
from cairn.operators.reduce import asc, desc
from cairn.plans.registry import query
from cairn.plans.roles import GROUPS, PRESSURE, RULES, RULES_CTE, UNITS, sql, sql_rule_match, tables

TS = "'%Y-%m-%d %H:%M:%S'"


def sec(name: str):
    return temporal.iso_second(F.col(name)).alias(name)


# ---- A: scans ------------------------------------------------------------------


@query("op_A9_scan_prune", "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-01-01' AND l_quantity > 45")
def _(v):
    (li,) = tables(v.spark, v.dir, "lineitem")
    return li.filter((F.col("l_shipdate") >= F.lit("2001-01-01").cast("timestamp_ntz")) & (F.col("l_quantity") > 45)).select("l_orderkey", "l_quantity")


@query("op_A8_union_by_name", "SELECT c_custkey AS id, c_name AS name, c_acctbal AS acctbal, CAST(NULL AS VARCHAR) AS brand FROM customer UNION ALL SELECT p_partkey, p_name, NULL, p_brand FROM part")
def _(v):
    c, p = tables(v.spark, v.dir, "customer", "part")
    a = c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("acctbal"))
    b = p.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand"))
    return a.unionByName(b, allowMissingColumns=True)


@query("op_A16_catalog", f"WITH {RULES_CTE} SELECT match_type, count(*) AS n, count(*) FILTER (WHERE include) AS included FROM rules GROUP BY match_type")
def _(v):
    cat = rules.catalog(v.spark, RULES)
    return cat.groupBy("match_type").agg(F.count("*").alias("n"), F.count_if("include").alias("included"))


@query("op_A17_compiled_catalog", "SELECT * FROM (VALUES ('money', 'exact', 1), ('seen', 'exact', 2), ('p_any', 'prefix', 1), ('all_v', 'exact', 1), ('all_v', 'prefix', 2)) AS t(rule, match_type, n)")
def _(v):
    return rules.catalog_of(v.spark, GROUPS.values(), "events").groupBy("rule", "match_type").agg(F.count("*").cast("int").alias("n"))


@query("op_A19_unique_subjects", sql("SELECT subject_id, sex, birth_year, region FROM subj"))
def _(v):
    return guards.unique(v.subj, ["subject_id"], "subjects").select("subject_id", "sex", "birth_year", "region")


@query("op_A6_head", "SELECT event_id, event_type FROM events ORDER BY event_id LIMIT 10")
def _(v):
    (e,) = tables(v.spark, v.dir, "events")
    return e.orderBy("event_id").limit(10).select("event_id", "event_type")


# ---- B: projections and predicates ----------------------------------------------


@query("op_B1_normalise_chunk", sql(f"SELECT event_id, upper(trim(code2)) AS code, regexp_replace(upper(trim(system)), '[^A-Z0-9]', '', 'g') AS system, TRY_CAST(raw_value AS DOUBLE) AS value, CASE WHEN raw_ts = 'bad' THEN NULL WHEN length(raw_ts) = 8 THEN strftime(strptime(raw_ts, '%Y%m%d'), {TS}) ELSE strftime(CAST(raw_ts AS TIMESTAMP), {TS}) END AS ts FROM ev"))
def _(v):
    return v.ev.select("event_id", scalar.norm_code(F.col("code2")).alias("code"), scalar.system_key(F.col("system")).alias("system"), scalar.number(F.col("raw_value")).alias("value"), temporal.iso_second(temporal.parse_timestamp(F.col("raw_ts"))).alias("ts"))


@query("op_B3_indicator_recode", sql("SELECT encounter_id, CASE state WHEN 'F' THEN 'U' WHEN 'P' THEN 'S' ELSE state END AS indicator FROM enc"))
def _(v):
    return v.enc.select("encounter_id", scalar.recode(F.col("state"), {"F": "U", "P": "S"}).alias("indicator"))


@query("op_B6_types", sql("SELECT encounter_id, type FROM enc WHERE type IN ('AMB', 'EMER', 'IMP')"))
def _(v):
    return v.enc.filter(F.col("type").isin("AMB", "EMER", "IMP")).select("encounter_id", "type")


@query("op_B7_na_tokens", sql("SELECT event_id, CASE WHEN raw_value IN ('n/a', 'NA', '', 'NULL') THEN NULL ELSE raw_value END AS raw_value FROM ev"))
def _(v):
    return v.ev.select("event_id", scalar.na_to_null(F.col("raw_value")).alias("raw_value"))


@query("op_B8_code_mask", sql("SELECT event_id, code2 FROM ev WHERE code2 = 'V12' OR starts_with(code2, 'P1')"))
def _(v):
    return v.ev.filter(rules.CodeRule("m", ("v12 ",), ("p1",)).mask(F.col("code2"))).select("event_id", "code2")


@query("op_B10_rule_fanout", sql("""SELECT g AS "group", event_id FROM ev JOIN (VALUES ('purchase','money'), ('view','seen'), ('click','seen'), ('purchase','p_any'), ('signup','all_v'), ('view','all_v'), ('error','all_v')) t(c, g) ON code = c"""))
def _(v):
    return rules.split_groups(v.ev, GROUPS, code="code").select("group", "event_id")


_JUDGED = """judged AS (SELECT *, TRY_CAST(raw_value AS DOUBLE) AS num, CASE lower(trim(coalesce(unit, ''))) WHEN 'mmhg' THEN 1.0 WHEN 'kpa' THEN 7.5006168270417 END AS f FROM ev WHERE code IN ('view', 'purchase')),
  outcomes AS (SELECT *, num * f AS value_std, CASE WHEN f IS NULL THEN 'rejected_unit' WHEN num IS NULL THEN 'rejected_non_numeric' WHEN NOT (num * f > 45 AND num * f < 200) THEN 'rejected_range' ELSE 'accepted' END AS outcome FROM judged)"""


@query("op_B11_numeric_rule", sql("SELECT event_id, round(value_std, 6) AS value_std FROM outcomes WHERE outcome = 'accepted'", _JUDGED))
def _(v):
    judged = rules.numeric_rule(v.ev, PRESSURE, code="code", value="raw_value", unit="unit")
    return judged.filter("outcome = 'accepted'").select("event_id", F.round("value_std", 6).alias("value_std"))


@query("op_B12_vital_rule", sql("SELECT event_id, round(CASE WHEN value > 43.3 THEN (value - 32) * 5 / 9 ELSE value END, 4) AS celsius FROM ev WHERE code = 'view' AND CASE WHEN value > 43.3 THEN (value - 32) * 5 / 9 ELSE value END >= 20 AND CASE WHEN value > 43.3 THEN (value - 32) * 5 / 9 ELSE value END < 43.3"))
def _(v):
    kept = rules.vital_rule(v.ev, code="code", value="value", codes=["view"], low=20, high=43.3, convert="celsius")
    return kept.select("event_id", F.round(scalar.to_celsius(F.col("value")), 4).alias("celsius"))


# half precision by arithmetic: the unit in the last place from the binary exponent, ties to even, then the fewest digits that come back to the same value
_HALF = """h AS (SELECT event_id, value, power(2.0, greatest(floor(log2(abs(value))), -14) - 10) AS ulp FROM ev WHERE value IS NOT NULL AND value <> 0),
  r AS (SELECT *, round_even(value / ulp, 0) * ulp AS half FROM h)"""


@query("op_B13_half_precision", sql("""SELECT event_id, value, seen FROM (SELECT event_id, value, list_filter(list_transform([0, 1, 2, 3, 4, 5, 6], lambda d: round_even(half, CAST(d - floor(log10(abs(half))) AS INTEGER))),
   lambda c: abs(c - half) < (CASE WHEN abs(c) < abs(half) AND log2(abs(half)) = floor(log2(abs(half))) THEN 0.25 ELSE 0.5 END) * power(2.0, greatest(floor(log2(abs(half))), -14) - 10))[1] AS seen FROM r WHERE half <> 0) WHERE seen > 10""", _HALF))
def _(v):
    return v.ev.select("event_id", "value", scalar.half_visible_or_null(F.col("value")).alias("seen")).filter(F.col("seen") > 10)


@query("op_B14_encounter_window", sql(f"""SELECT encounter_id, strftime(coalesce("end", TIMESTAMP '2001-12-31'), {TS}) AS "end" FROM enc WHERE type IN ('AMB','EMER','IMP') AND start >= TIMESTAMP '2000-01-01'"""))
def _(v):
    kept = v.enc.filter(F.col("type").isin("AMB", "EMER", "IMP") & (F.col("start") >= F.lit("2000-01-01").cast("timestamp_ntz")))
    return kept.withColumn("end", F.coalesce("end", F.lit("2001-12-31").cast("timestamp_ntz"))).select("encounter_id", sec("end"))


@query("op_B15_los", sql("""SELECT encounter_id, CAST(floor(date_diff('second', start, "end") / 86400.0) AS BIGINT) + 1 AS los FROM enc WHERE "end" IS NOT NULL AND floor(date_diff('second', start, "end") / 86400.0) + 1 > 0"""))
def _(v):
    return v.enc.select("encounter_id", (temporal.whole_days(F.col("start"), F.col("end")) + 1).alias("los")).filter("los > 0")


@query("op_B16_event_window", sql("SELECT event_id FROM ev WHERE ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20' AND subject_id IS NOT NULL"))
def _(v):
    return v.ev.filter(F.col("ts").between(F.lit("2024-01-10").cast("timestamp_ntz"), F.lit("2024-01-20").cast("timestamp_ntz"))).na.drop(subset=["subject_id", "ts"]).select("event_id")


@query("op_B17_location_dropna", sql("SELECT subject_id, region FROM subj WHERE region NOT IN ('ASIA', 'AFRICA') AND region IS NOT NULL AND segment IS NOT NULL AND balance IS NOT NULL"))
def _(v):
    return v.subj.filter(~F.col("region").isin("ASIA", "AFRICA")).na.drop("any").select("subject_id", "region")


@query("op_B18_age", sql("SELECT event_id, year(ts) - birth_year AS age FROM ev JOIN subj USING (subject_id) WHERE year(ts) - birth_year >= 18 AND year(ts) - birth_year < 110"))
def _(v):
    aged = v.ev.join(v.subj, "subject_id").select("event_id", (F.year("ts").cast("bigint") - F.col("birth_year")).alias("age"))
    return aged.filter((F.col("age") >= 18) & (F.col("age") < 110))


@query("op_B20_compiled_predicate", sql("SELECT event_id FROM ev e WHERE EXISTS (SELECT 1 FROM rules r WHERE " + sql_rule_match() + ")", RULES_CTE))
def _(v):
    return v.ev.filter(rules.predicate([(s, c, m) for _, _, s, c, m, on in RULES if on], F.col("code2"), F.col("system"))).select("event_id")


@query("op_B21_typed_null", sql("SELECT event_id, code, CAST(NULL AS VARCHAR) AS route FROM ev"))
def _(v):
    from cairn.sources.readers import project

    return project(v.ev, ["event_id", "code"], ["route"])


@query("op_B22_exclude", "SELECT * EXCLUDE (c_name, c_nationkey) FROM customer")
def _(v):
    (c,) = tables(v.spark, v.dir, "customer")
    return c.drop("c_name", "c_nationkey")


@query("op_B23_lateral_alias", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice * (1 - l_discount) AS net, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS gross FROM lineitem")
def _(v):
    (li,) = tables(v.spark, v.dir, "lineitem")
    return v.spark.sql("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice * (1 - l_discount) AS net, net * (1 + l_tax) AS gross FROM {li}", li=li)


@query("op_B24_unit_case", sql("SELECT event_id, unit_std, round(value_std, 6) AS value_std, coalesce(value_std BETWEEN 10 AND 250, false) AS plausible FROM (SELECT *, TRY_CAST(raw_value AS DOUBLE) * CASE lower(trim(coalesce(unit, ''))) WHEN 'mmhg' THEN 1.0 WHEN 'kpa' THEN 7.5006168270417 WHEN '' THEN 1.0 END AS value_std, CASE WHEN coalesce(unit, '') <> 'mg' THEN 'mmHg' END AS unit_std FROM ev)"))
def _(v):
    out = rules.normalise_units(v.ev, value="raw_value", unit="unit", factors=UNITS, low=10, high=250)
    return out.select("event_id", "unit_std", F.round("value_std", 6).alias("value_std"), "plausible")


@query("op_B25_regex_stage", sql("SELECT event_id, regexp_extract(code2, '^[A-Z]([0-9])$', 1) AS stage FROM ev"))
def _(v):
    return v.ev.select("event_id", F.regexp_extract("code2", "^[A-Z]([0-9])$", 1).alias("stage"))


@query("op_B26_anthropometrics", sql("SELECT event_id, round(CASE WHEN event_id % 2 = 0 THEN value * 0.45359237 ELSE value END, 6) AS kg FROM ev WHERE CASE WHEN event_id % 2 = 0 THEN value * 0.45359237 ELSE value END BETWEEN 20 AND 500"))
def _(v):
    kg = F.when(F.col("event_id") % 2 == 0, F.col("value") * scalar.LB_TO_KG).otherwise(F.col("value"))
    return v.ev.withColumn("kg", kg).filter(F.col("kg").between(20, 500)).select("event_id", F.round("kg", 6).alias("kg"))


_LADDER = "CASE WHEN type = 'OTHER' THEN 'type' WHEN \"end\" IS NULL THEN 'open' WHEN \"end\" < start THEN 'interval' WHEN cost < 50000 THEN 'cost' END"


@query("op_B27_reason_ladder", sql(f"SELECT encounter_id, {_LADDER} AS reason, CASE WHEN {_LADDER} IS NULL THEN 'included' ELSE 'excluded' END AS status FROM enc"))
def _(v):
    status, reason = rules.first_reason((F.col("type") == "OTHER", "type"), (F.col("end").isNull(), "open"), (F.col("end") < F.col("start"), "interval"), (F.col("cost") < 50000, "cost"))
    return v.enc.select("encounter_id", reason.alias("reason"), status.alias("status"))


@query("op_B28_cleaned", sql("SELECT encounter_id FROM enc WHERE NOT coalesce(\"end\" < start, false) AND NOT coalesce(cost > 300000, false)"))
def _(v):
    return v.enc.filter(~F.coalesce(F.col("end") < F.col("start"), F.lit(False)) & ~F.coalesce(F.col("cost") > 300000, F.lit(False))).select("encounter_id")


@query("op_B29_recode", sql("SELECT subject_id, CASE sex WHEN 'F' THEN 'Female' WHEN 'M' THEN 'Male' ELSE sex END AS sex, CASE region WHEN 'ASIA' THEN 'A' ELSE region END AS region FROM subj"))
def _(v):
    return v.subj.select("subject_id", scalar.recode(F.col("sex"), {"F": "Female", "M": "Male"}).alias("sex"), scalar.recode(F.col("region"), {"ASIA": "A"}).alias("region"))


@query("op_B31_death_month", sql("SELECT event_id, CASE WHEN event_id % 5 = 0 THEN '' ELSE substr(strftime(ts, '%Y%m'), 1, 4) || '-' || substr(strftime(ts, '%Y%m'), 5, 2) END AS month FROM ev"))
def _(v):
    raw = F.when(F.col("event_id") % 5 == 0, "0").otherwise(F.date_format("ts", "yyyyMM"))
    return v.ev.select("event_id", scalar.death_month(raw).alias("month"))


@query("op_B33_require_columns", sql("SELECT encounter_id, subject_id FROM enc"))
def _(v):
    from cairn.sources.readers import require_columns

    return require_columns(v.enc, ["encounter_id", "subject_id"]).select("encounter_id", "subject_id")


# ---- C: joins --------------------------------------------------------------------


@query("op_C1_concept_join", sql("SELECT r.rule, e.event_id FROM ev e JOIN (SELECT DISTINCT * FROM rules) r ON " + sql_rule_match() + " GROUP BY ALL", RULES_CTE))
def _(v):
    return rules.match_codes(v.ev, rules.catalog(v.spark, RULES), code="code2", system="system").select("rule", "event_id")


@query("op_C1_concept_left", sql("SELECT DISTINCT r.rule, e.event_id FROM ev e LEFT JOIN rules r ON " + sql_rule_match(), RULES_CTE))
def _(v):
    return rules.match_codes(v.ev, rules.catalog(v.spark, RULES), code="code2", system="system", how="left").select("rule", "event_id")


_WIDE = "wide AS (SELECT * FROM rules UNION ALL SELECT 'n' || CAST(i AS VARCHAR), 'dx', 'ANY', 'X' || CAST(i AS VARCHAR), 'prefix', true FROM range(5000) t(i) UNION ALL SELECT 'c' || CAST(i AS VARCHAR), 'dx', 'LOINC', 'C' || CAST(i AS VARCHAR), 'prefix', true FROM range(20) t(i))"


@query("op_C1_large_catalog", sql("SELECT r.rule, e.event_id FROM ev e JOIN (SELECT DISTINCT * FROM wide) r ON " + sql_rule_match() + " GROUP BY ALL", RULES_CTE, _WIDE))
def _(v):
    more = [(f"n{i}", "dx", "ANY", f"X{i}", "prefix", True) for i in range(5000)] + [(f"c{i}", "dx", "LOINC", f"C{i}", "prefix", True) for i in range(20)]
    return rules.match_codes(v.ev, rules.catalog(v.spark, [*RULES, *more]), code="code2", system="system").select("rule", "event_id")


@query("op_C3_guarded_left", sql("SELECT encounter_id, region, birth_year FROM enc LEFT JOIN subj USING (subject_id)"))
def _(v):
    return joins.guarded_left(v.enc, v.subj, ["subject_id"]).select("encounter_id", "region", "birth_year")


@query("op_C4_replace_left", sql("SELECT s.subject_id, s.sex, x.balance FROM subj s LEFT JOIN (SELECT subject_id, round(max(cost), 2) AS balance FROM enc GROUP BY 1) x USING (subject_id)"))
def _(v):
    newest = v.enc.groupBy("subject_id").agg(F.round(F.max("cost"), 2).alias("balance"))
    return joins.replace_left(v.subj, newest, ["subject_id"]).select("subject_id", "sex", "balance")


@query("op_C5_first_last", sql(f"SELECT subject_id, code, strftime(min(ts), {TS}) AS first_ts, strftime(max(ts), {TS}) AS last_ts FROM ev GROUP BY 1, 2"))
def _(v):
    return v.ev.groupBy("subject_id", "code").agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")).select("subject_id", "code", sec("first_ts"), sec("last_ts"))


@query("op_C6_multi_left", sql("SELECT s.subject_id, a.n_ev, b.n_enc, c.top FROM subj s LEFT JOIN (SELECT subject_id, count(*) AS n_ev FROM ev GROUP BY 1) a USING (subject_id) LEFT JOIN (SELECT subject_id, count(*) AS n_enc FROM enc GROUP BY 1) b USING (subject_id) LEFT JOIN (SELECT subject_id, max(value) AS top FROM ev WHERE code = 'purchase' GROUP BY 1) c USING (subject_id)"))
def _(v):
    parts = [v.ev.groupBy("subject_id").agg(F.count("*").alias("n_ev")), v.enc.groupBy("subject_id").agg(F.count("*").alias("n_enc")), v.ev.filter("code = 'purchase'").groupBy("subject_id").agg(F.max("value").alias("top"))]
    return joins.left_all(v.subj.select("subject_id"), parts, ["subject_id"])


@query("op_C7_least_first", sql(f"SELECT s.subject_id, strftime(least(a.t, b.t), {TS}) AS first_seen FROM subj s LEFT JOIN (SELECT subject_id, min(ts) AS t FROM ev GROUP BY 1) a USING (subject_id) LEFT JOIN (SELECT subject_id, min(start) AS t FROM enc GROUP BY 1) b USING (subject_id)"))
def _(v):
    parts = [v.ev.groupBy("subject_id").agg(F.min("ts").alias("a")), v.enc.groupBy("subject_id").agg(F.min("start").alias("b"))]
    out = joins.left_all(v.subj.select("subject_id"), parts, ["subject_id"])
    return out.select("subject_id", temporal.iso_second(F.least("a", "b")).alias("first_seen"))


@query("op_C9_semi", sql("SELECT encounter_id FROM enc WHERE subject_id IN (SELECT subject_id FROM ev WHERE code = 'error')"))
def _(v):
    return joins.semi(v.enc, v.ev.filter("code = 'error'"), ["subject_id"]).select("encounter_id")


@query("op_C10_anti", sql("SELECT event_id FROM ev WHERE encounter_id NOT IN (SELECT encounter_id FROM ev WHERE code = 'error' AND value > 20)"))
def _(v):
    return joins.anti(v.ev, v.ev.filter("code = 'error' AND value > 20"), ["encounter_id"]).select("event_id")


@query("op_C11_semi_either", sql("SELECT event_id FROM ev WHERE subject_id IN (SELECT subject_id FROM subj WHERE region = 'ASIA') OR encounter_id IN (SELECT encounter_id FROM enc WHERE type = 'EMER')"))
def _(v):
    return joins.semi_either(v.ev, ("subject_id", v.subj.filter("region = 'ASIA'"), "subject_id"), ("encounter_id", v.enc.filter("type = 'EMER'"), "encounter_id")).select("event_id")


@query("op_C12_exists", sql("SELECT subject_id FROM subj s WHERE EXISTS (SELECT 1 FROM ev e WHERE e.subject_id = s.subject_id AND e.value > 60)"))
def _(v):
    return v.spark.sql("SELECT subject_id FROM {subj} s WHERE EXISTS (SELECT 1 FROM {ev} e WHERE e.subject_id = s.subject_id AND e.value > 60)", subj=v.subj, ev=v.ev)


@query("op_C13_anti_join", "SELECT c_custkey FROM customer ANTI JOIN events ON c_custkey = user_id")
def _(v):
    c, e = tables(v.spark, v.dir, "customer", "events")
    return joins.anti(c, e.select(F.col("user_id").alias("c_custkey")), ["c_custkey"]).select("c_custkey")


@query("op_C14_orphans", "SELECT count(*) AS orphans FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey WHERE o_orderkey IS NULL")
def _(v):
    li, o = tables(v.spark, v.dir, "lineitem", "orders")
    return joins.anti(li.select("l_orderkey"), o.select(F.col("o_orderkey").alias("l_orderkey")), ["l_orderkey"]).agg(F.count("*").alias("orphans"))


_SHIFT = "enc24 AS (SELECT encounter_id, subject_id, TIMESTAMP '2024-01-01' + to_days(CAST(encounter_id % 30 AS INTEGER)) AS start, TIMESTAMP '2024-01-01' + to_days(CAST(encounter_id % 30 + encounter_id % 5 AS INTEGER)) AS stop, type FROM enc)"


def _enc24(v):
    """Encounters moved into the events' month."""
    begin = F.lit("2024-01-01").cast("timestamp_ntz")
    i = F.col("encounter_id")
    return v.enc.select("encounter_id", "subject_id", (begin + F.make_dt_interval((i % 30).cast("int"))).alias("start"), (begin + F.make_dt_interval((i % 30 + i % 5).cast("int"))).alias("stop"), "type")


@query("op_C15_interval", sql("SELECT n.encounter_id, e.event_id FROM enc24 n JOIN ev e ON e.subject_id = n.subject_id AND e.ts >= n.start AND e.ts <= n.start + INTERVAL 24 HOUR", _SHIFT))
def _(v):
    right = v.ev.select("subject_id", "event_id", "ts")
    stop = F.col("start") + F.expr("INTERVAL '24' HOUR")
    return joins.within_cells(_enc24(v), right, ["subject_id"], start=F.col("start"), stop=stop, ts="ts", cell=86_400, test=F.col("ts").between(F.col("start"), stop)).select("encounter_id", "event_id")


@query("op_C16_inclusive_end", sql("SELECT n.encounter_id, e.event_id FROM enc24 n JOIN ev e ON e.subject_id = n.subject_id AND e.ts >= n.start AND e.ts <= n.stop + INTERVAL 1 DAY - INTERVAL 1 MICROSECOND WHERE n.type <> 'OTHER'", _SHIFT))
def _(v):
    right = v.ev.select("subject_id", "event_id", "ts")
    left = _enc24(v).filter("type <> 'OTHER'")
    stop = temporal.inclusive_end(F.col("stop"), F.lit(temporal.DATE_ONLY))
    return joins.within_cells(left, right, ["subject_id"], start=F.col("start"), stop=stop, ts="ts", test=F.col("ts").between(F.col("start"), stop)).select("encounter_id", "event_id")


_INDEX = "idx AS (SELECT event_id AS index_id, subject_id, ts AS index_ts, value AS index_value FROM (SELECT *, row_number() OVER (PARTITION BY subject_id ORDER BY ts, event_id) AS r FROM ev WHERE code = 'purchase') WHERE r = 1)"


def _index(v):
    return reduce.keep_first(v.ev.filter("code = 'purchase'"), ["subject_id"], [asc("ts"), asc("event_id")]).select(F.col("event_id").alias("index_id"), "subject_id", F.col("ts").alias("index_ts"), F.col("value").alias("index_value"))


@query("op_C17_look_back", sql("SELECT index_id, event_id FROM idx JOIN ev USING (subject_id) WHERE code = 'view' AND CASE WHEN event_id % 2 = 0 THEN date_trunc('day', ts) <= date_trunc('day', index_ts) AND date_trunc('day', ts) >= date_trunc('day', index_ts) - INTERVAL 7 DAY ELSE ts <= index_ts AND ts >= index_ts - INTERVAL 7 DAY END", _INDEX))
def _(v):
    kind = F.when(F.col("event_id") % 2 == 0, temporal.DATE_ONLY).otherwise(temporal.TIMESTAMP)
    day, at = F.date_trunc("day", "index_ts").cast("timestamp_ntz"), F.col("index_ts")  # both kinds lie between seven days before the day and its end
    window = {"start": day - F.expr("INTERVAL '7' DAY"), "stop": day + F.expr("INTERVAL '1' DAY"), "ts": "ts", "cell": 8 * 86_400}
    return joins.within_cells(_index(v), v.ev.filter("code = 'view'").select("subject_id", "event_id", "ts"), ["subject_id"], test=temporal.in_look_back(F.col("ts"), kind, at, 7), **window).select("index_id", "event_id")


@query("op_C18_follow_up", sql("SELECT index_id, event_id, ts <= index_ts + INTERVAL 3 DAY AS early FROM idx JOIN ev USING (subject_id) WHERE code = 'error' AND ts > index_ts AND ts <= index_ts + INTERVAL 9 DAY", _INDEX))
def _(v):
    at, last = F.col("index_ts"), temporal.days_from(F.col("index_ts"), 9)
    hits = joins.within_cells(_index(v), v.ev.filter("code = 'error'").select("subject_id", "event_id", "ts"), ["subject_id"], start=at, stop=last, ts="ts", cell=9 * 86_400, test=(F.col("ts") > at) & (F.col("ts") <= last))
    return hits.select("index_id", "event_id", (F.col("ts") <= temporal.days_from(F.col("index_ts"), 3)).alias("early"))


@query("op_C19_asof_forward", sql("SELECT index_id, f.event_id AS follow_id, f.value AS follow_value FROM idx LEFT JOIN LATERAL (SELECT event_id, value FROM ev WHERE ev.subject_id = idx.subject_id AND code = 'purchase' AND ts >= index_ts + INTERVAL 2 DAY AND ts <= index_ts + INTERVAL 14 DAY ORDER BY ts, event_id LIMIT 1) f ON true", _INDEX))
def _(v):
    right = v.ev.filter("code = 'purchase'").select("subject_id", F.col("event_id").alias("follow_id"), F.col("ts").alias("follow_ts"), F.col("value").alias("follow_value"))
    return joins.as_of_forward(_index(v), right, ["subject_id"], left_ts="index_ts", right_ts="follow_ts", first_days=2, last_days=14, values=["follow_id", "follow_value"], tie="follow_id", left_id=["index_id"]).select("index_id", "follow_id", "follow_value")


@query("op_C20_asof_backward", sql("SELECT index_id, p.event_id AS prev_id, p.value AS prev_value FROM idx LEFT JOIN LATERAL (SELECT event_id, value FROM ev WHERE ev.subject_id = idx.subject_id AND code = 'view' AND ts < index_ts ORDER BY ts DESC, event_id DESC LIMIT 1) p ON true", _INDEX))
def _(v):
    right = v.ev.filter("code = 'view'").select("subject_id", F.col("event_id").alias("prev_id"), F.col("ts").alias("prev_ts"), F.col("value").alias("prev_value"))
    return joins.as_of_backward(_index(v), right, ["subject_id"], left_ts="index_ts", right_ts="prev_ts", values=["prev_id", "prev_value"], tie="prev_id").select("index_id", "prev_id", "prev_value")


@query("op_C21_pair_nearest", sql("""SELECT ref_id, other_id, CAST(level AS INTEGER) AS level FROM (SELECT a.event_id AS ref_id, b.event_id AS other_id, CASE WHEN a.encounter_id = b.encounter_id THEN 1 WHEN abs(date_diff('minute', a.ts, b.ts)) <= 30 THEN 2 WHEN CAST(a.ts AS DATE) = CAST(b.ts AS DATE) THEN 3 END AS level,
   row_number() OVER (PARTITION BY a.event_id ORDER BY CASE WHEN a.encounter_id = b.encounter_id THEN 1 WHEN abs(date_diff('minute', a.ts, b.ts)) <= 30 THEN 2 WHEN CAST(a.ts AS DATE) = CAST(b.ts AS DATE) THEN 3 END NULLS LAST, abs(date_diff('second', a.ts, b.ts)), b.event_id) AS r
   FROM ev a JOIN ev b ON a.subject_id = b.subject_id WHERE a.code = 'purchase' AND b.code = 'click') WHERE r = 1 AND level IS NOT NULL"""))
def _(v):
    a = v.ev.filter("code = 'purchase'").select("subject_id", F.col("event_id").alias("ref_id"), F.col("ts").alias("ref_ts"), F.col("encounter_id").alias("ref_enc"))
    b = v.ev.filter("code = 'click'").select("subject_id", F.col("event_id").alias("other_id"), F.col("ts").alias("other_ts"), F.col("encounter_id").alias("other_enc"))
    x, y = F.col("ref_ts"), F.col("other_ts")
    day, near = F.to_date(x), F.abs(temporal.boundaries("minute", x, y)) <= 30
    levels = [(F.col("ref_enc"), F.col("other_enc"), F.lit(True)), (F.array(F.date_sub(day, 1), day, F.date_add(day, 1)), F.to_date(y), near), (day, F.to_date(y), F.lit(True))]
    out = joins.pair_by_levels(a, b, ["subject_id"], left_id="ref_id", order=[F.abs(temporal.boundaries("second", x, y)).asc(), asc("other_id")], levels=levels)
    return out.select("ref_id", "other_id", F.col("level").cast("int").alias("level"))


@query("op_C22_self_pair", sql("SELECT ref_id, other_id, gap_seconds FROM (SELECT a.event_id AS ref_id, b.event_id AS other_id, abs(date_diff('second', a.ts, b.ts)) AS gap_seconds, row_number() OVER (PARTITION BY a.event_id ORDER BY abs(date_diff('second', a.ts, b.ts)), b.event_id) AS r FROM ev a JOIN ev b ON a.subject_id = b.subject_id AND abs(date_diff('second', a.ts, b.ts)) <= 24 * 3600 WHERE a.code = 'signup' AND b.code = 'purchase') WHERE r = 1"))
def _(v):
    from cairn.operators.cohort import pair_measures

    a = v.ev.filter("code = 'signup'").select("subject_id", F.col("event_id").alias("ref_id"), F.col("ts").alias("ref_ts"))
    b = v.ev.filter("code = 'purchase'").select("subject_id", F.col("event_id").alias("other_id"), F.col("ts").alias("other_ts"))
    return pair_measures(a, b, ["subject_id"], left_id="ref_id", left_ts="ref_ts", right_ts="other_ts", hours=24, tie="other_id").select("ref_id", "other_id", "gap_seconds")


@query("op_C23_update_from", sql("SELECT s.subject_id, coalesce(x.region, s.region) AS region, s.segment FROM subj s LEFT JOIN (SELECT subject_id, CASE WHEN count(*) > 60 THEN 'BUSY' END AS region FROM ev GROUP BY 1) x USING (subject_id)"))
def _(v):
    patch = v.ev.groupBy("subject_id").agg(F.when(F.count("*") > 60, "BUSY").alias("region"))
    return joins.merge_update(v.subj.select("subject_id", "region", "segment"), patch, ["subject_id"], ["region"])


@query("op_C24_key_lookup", sql("SELECT e.event_id, s.birth_year FROM ev e JOIN subj s USING (subject_id) WHERE e.code = 'signup'"))
def _(v):
    return v.ev.filter("code = 'signup'").join(guards.unique(v.subj, ["subject_id"]), "subject_id").select("event_id", "birth_year")


@query("op_C26_map_join", sql(f"SELECT e.event_id, strftime(index_ts, {TS}) AS index_ts FROM ev e JOIN idx USING (subject_id)", _INDEX))
def _(v):
    return v.ev.join(_index(v), "subject_id").select("event_id", sec("index_ts"))


@query("op_C28_intersect", "SELECT user_id AS id FROM events WHERE event_type = 'signup' INTERSECT SELECT user_id FROM events WHERE event_type = 'error' INTERSECT SELECT c_custkey FROM customer")
def _(v):
    e, c = tables(v.spark, v.dir, "events", "customer")
    a, b = (e.filter(F.col("event_type") == t).select(F.col("user_id").alias("id")) for t in ("signup", "error"))
    return a.intersect(b).intersect(c.select(F.col("c_custkey").alias("id")))


@query("op_C29_configured_totals", sql("SELECT r.rule, coalesce(m.n, 0) AS n FROM (SELECT DISTINCT rule FROM rules) r LEFT JOIN (SELECT r.rule, count(DISTINCT e.event_id) AS n FROM ev e JOIN rules r ON " + sql_rule_match() + " GROUP BY 1) m USING (rule)", RULES_CTE))
def _(v):
    cat = rules.catalog(v.spark, RULES)
    hits = rules.match_codes(v.ev, cat, code="code2", system="system").groupBy("rule").agg(F.count("*").alias("n"))
    return cat.select("rule").distinct().join(hits, "rule", "left").select("rule", F.coalesce("n", F.lit(0)).alias("n"))


# ---- D: aggregations ----------------------------------------------------------------


@query("op_D1_flag_pivot", sql("SELECT subject_id, bool_or(code = 'view') AS view, bool_or(code = 'purchase') AS purchase, bool_or(code = 'error') AS error FROM ev GROUP BY 1"))
def _(v):
    return aggregate.flag_pivot(v.ev, ["subject_id"], "code", ["view", "purchase", "error"])


@query("op_D2_filter_agg", sql("SELECT subject_id, max(value) FILTER (WHERE code = 'view') AS top_view, min(value) FILTER (WHERE code = 'purchase') AS low_purchase FROM ev GROUP BY 1"))
def _(v):
    return v.ev.groupBy("subject_id").agg(aggregate.max_where("value", F.col("code") == "view").alias("top_view"), aggregate.min_where("value", F.col("code") == "purchase").alias("low_purchase"))


@query("op_D3_count_filter", sql("SELECT subject_id, count(*) FILTER (WHERE value > 20) AS high, count(DISTINCT encounter_id) FILTER (WHERE code = 'click') AS encs FROM ev GROUP BY 1"))
def _(v):
    return v.ev.groupBy("subject_id").agg(F.count_if(F.col("value") > 20).alias("high"), aggregate.distinct_where("encounter_id", F.col("code") == "click").alias("encs"))


@query("op_D4_ordered_first", sql("SELECT subject_id, first(value ORDER BY ts DESC, event_id DESC) FILTER (WHERE code = 'view') AS latest_view, first(unit ORDER BY ts, event_id) AS first_unit FROM ev GROUP BY 1"))
def _(v):
    return v.ev.groupBy("subject_id").agg(reduce.last_value("value", "ts", "event_id", where=F.col("code") == "view").alias("latest_view"), reduce.first_value("unit", "ts", "event_id").alias("first_unit"))


@query("op_D4_null_order", sql("SELECT subject_id, first(value ORDER BY t DESC NULLS LAST, event_id DESC) AS latest, first(value ORDER BY t NULLS LAST, event_id) AS earliest FROM (SELECT *, CASE WHEN event_id % 3 = 0 THEN NULL ELSE ts END AS t FROM ev) GROUP BY 1"))
def _(v):
    some = v.ev.withColumn("t", F.when(F.col("event_id") % 3 != 0, F.col("ts")))
    return some.groupBy("subject_id").agg(reduce.last_value("value", "t", "event_id").alias("latest"), reduce.first_value("value", "t", "event_id").alias("earliest"))


@query("op_D5_tuple_distinct", sql("SELECT code, count(DISTINCT (unit, system)) AS pairs FROM ev GROUP BY 1"))
def _(v):
    return v.ev.groupBy("code").agg(aggregate.tuple_distinct("unit", "system").alias("pairs"))


@query("op_D6_min_year", sql("SELECT region, min(birth_year) AS birth_year FROM subj GROUP BY 1"))
def _(v):
    return v.subj.groupBy("region").agg(F.min("birth_year").alias("birth_year"))


@query("op_D8_observability", sql(f"SELECT subject_id, unit, count(*) AS n_events, strftime(min(ts), {TS}) AS first_ts FROM ev GROUP BY 1, 2"))
def _(v):
    return aggregate.observability(v.ev, ["subject_id", "unit"], "ts").select("subject_id", "unit", "n_events", sec("first_ts"))


@query("op_D9_patient_observability", sql(f"SELECT subject_id, CAST(sum(n) AS BIGINT) AS n_events, strftime(min(a), {TS}) AS first_ts, strftime(max(z), {TS}) AS last_ts FROM (SELECT subject_id, code, count(*) AS n, min(ts) AS a, max(ts) AS z FROM ev GROUP BY 1, 2) GROUP BY 1"))
def _(v):
    by = aggregate.observability(v.ev, ["subject_id", "code"], "ts")
    return by.groupBy("subject_id").agg(F.sum("n_events").alias("n_events"), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts")).select("subject_id", "n_events", sec("first_ts"), sec("last_ts"))


@query("op_D10_availability", sql("SELECT encounter_id, bool_or(k = 'dx') AS dx, bool_or(k = 'lab') AS lab FROM (SELECT encounter_id, 'dx' AS k FROM ev WHERE code = 'click' UNION ALL SELECT encounter_id, 'lab' FROM ev WHERE code = 'purchase') GROUP BY 1"))
def _(v):
    return aggregate.availability({"dx": v.ev.filter("code = 'click'"), "lab": v.ev.filter("code = 'purchase'")}, "encounter_id")


@query("op_D11_index_observability", sql(f"SELECT index_id, count(e.event_id) FILTER (WHERE ts <= index_ts) AS before, count(e.event_id) FILTER (WHERE ts > index_ts) AS after, strftime(min(ts), {TS}) AS first_ts FROM idx LEFT JOIN ev e USING (subject_id) GROUP BY 1", _INDEX))
def _(v):
    hits = _index(v).join(v.ev.select("subject_id", "event_id", "ts"), "subject_id", "left")
    return hits.groupBy("index_id").agg(F.count_if(F.col("ts") <= F.col("index_ts")).alias("before"), F.count_if(F.col("ts") > F.col("index_ts")).alias("after"), temporal.iso_second(F.min("ts")).alias("first_ts"))


@query("op_D12_priority", sql("SELECT subject_id, state FROM (SELECT subject_id, state, row_number() OVER (PARTITION BY subject_id ORDER BY CASE state WHEN 'P' THEN 3 WHEN 'F' THEN 2 WHEN 'O' THEN 1 END DESC, encounter_id) AS r FROM enc) WHERE r = 1"))
def _(v):
    return v.enc.groupBy("subject_id").agg(reduce.by_priority("state", {"P": 3, "F": 2, "O": 1}, "encounter_id").alias("state"))


@query("op_D13_distinct_matches", sql("SELECT r.rule, count(DISTINCT sha256(concat_ws(chr(31), e.code2, e.system, CAST(e.subject_id AS VARCHAR)))) AS n FROM ev e JOIN rules r ON " + sql_rule_match() + " GROUP BY 1", RULES_CTE))
def _(v):
    hits = rules.match_codes(v.ev, rules.catalog(v.spark, RULES), code="code2", system="system")
    return aggregate.distinct_by_shards(hits, ["rule"], scalar.record_id(F.col("code2"), F.col("system"), F.col("subject_id")), "n")


@query("op_D14_duplicates", "SELECT count(*) AS rows, count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_rows, count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicates FROM lineitem")
def _(v):
    (li,) = tables(v.spark, v.dir, "lineitem")
    return aggregate.duplicates(li, "l_orderkey", "l_linenumber")


@query("op_D15_completeness", sql("SELECT r.rule, r.rules, coalesce(m.n, 0) AS memberships, coalesce(m.s, 0) AS sources FROM (SELECT rule, count(*) AS rules FROM rules GROUP BY 1) r LEFT JOIN (SELECT rule, count(*) AS n, count(DISTINCT source_id) AS s FROM (SELECT DISTINCT r.rule, e.event_id, e.encounter_id AS source_id FROM ev e JOIN rules r ON " + sql_rule_match() + ") GROUP BY 1) m USING (rule)", RULES_CTE))
def _(v):
    cat = rules.catalog(v.spark, RULES)
    hits = rules.match_codes(v.ev, cat, code="code2", system="system").select("rule", F.col("encounter_id").alias("source_id"))
    return aggregate.completeness(cat.select("rule").distinct(), cat, hits, "rule")


@query("op_D16_having", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def _(v):
    (li,) = tables(v.spark, v.dir, "lineitem")
    return aggregate.surplus_keys(li, ["l_orderkey", "l_linenumber"])


@query("op_D17_catalog_dedupe", f"WITH {RULES_CTE} SELECT rule, min(domain) AS domain, min(code) AS code FROM rules GROUP BY 1")
def _(v):
    return rules.catalog(v.spark, RULES).groupBy("rule").agg(F.min("domain").alias("domain"), F.min("code").alias("code"))


@query("op_D18_conflicts", sql("SELECT kinds, count(*) AS keys FROM (SELECT subject_id, string_agg(type, '+' ORDER BY type) AS kinds, count(*) AS n FROM (SELECT DISTINCT subject_id, type FROM enc) GROUP BY 1) WHERE n > 1 GROUP BY 1"))
def _(v):
    return aggregate.conflicts(v.enc, "subject_id", "type")


@query("op_D19_heavy_hitters", sql("SELECT code2, system, count(*) AS n, CAST(0 AS BIGINT) AS error FROM ev GROUP BY 1, 2 ORDER BY n DESC, code2, system LIMIT 25"))
def _(v):
    return frequent.heavy_hitters(v.ev, ["code2", "system"], 25)


_BOUND = 1_000
_PARTNER = "CASE WHEN l_linenumber = 1 THEN -l_suppkey ELSE l_orderkey END"


@query("op_D19_bounded", f"SELECT {_PARTNER} AS partner, count(*) AS n, true AS within FROM lineitem GROUP BY 1 HAVING count(*) > (SELECT count(*) FROM lineitem) / {_BOUND}.0")
def _(v):
    """Many more keys than the counters hold: every key above rows / capacity is reported, with a true count within its bounds."""
    (li,) = tables(v.spark, v.dir, "lineitem")
    keys = li.select(F.expr(_PARTNER).alias("partner"))
    found = frequent.heavy_hitters(keys, ["partner"], _BOUND, capacity=_BOUND).withColumnRenamed("n", "most")
    exact = keys.join(F.broadcast(found), "partner").groupBy("partner", "most", "error").agg(F.count("*").alias("n"))
    least = keys.agg((F.count("*") / _BOUND).alias("least"))  # one row
    return exact.join(F.broadcast(least), F.col("n") > F.col("least")).select("partner", "n", F.col("n").between(F.col("most") - F.col("error"), F.col("most")).alias("within"))


@query("op_D19_by_domain", sql("SELECT domain, code, n, error FROM (SELECT code AS domain, code2 AS code, count(*) AS n, CAST(0 AS BIGINT) AS error, row_number() OVER (PARTITION BY code ORDER BY count(*) DESC, code2) AS r FROM ev GROUP BY 1, 2) WHERE r <= 5"))
def _(v):
    codes = v.ev.select(F.col("code").alias("domain"), F.col("code2").alias("code"))
    return frequent.heavy_hitters(codes, ["code"], 5, by=["domain"]).select("domain", "code", "n", "error")


@query("op_D21_value_counts", sql("SELECT type, count(*) AS n, count(DISTINCT subject_id) AS subjects FROM enc GROUP BY 1"))
def _(v):
    return v.enc.groupBy("type").agg(F.count("*").alias("n"), F.count_distinct("subject_id").alias("subjects"))


@query("op_D22_histogram", sql("SELECT CAST(least(floor(value / 5), 99) AS BIGINT) AS bin, count(*) AS n FROM ev WHERE value BETWEEN 0 AND 500 GROUP BY 1"))
def _(v):
    return aggregate.histogram(v.ev, "value", 0, 500, 100)


@query("op_D22_quartiles", sql("SELECT code, round(quantile_cont(value, 0.25), 6) AS q1, round(quantile_cont(value, 0.5), 6) AS q2, round(quantile_cont(value, 0.75), 6) AS q3 FROM ev GROUP BY 1"))
def _(v):
    return aggregate.quartiles(v.ev, "value", "code").select("code", *[F.round(c, 6).alias(c) for c in ("q1", "q2", "q3")])


@query("op_D23_audit", sql("SELECT count(*) AS considered, count(*) FILTER (WHERE outcome = 'accepted') AS accepted, CAST(0 AS BIGINT) AS rejected_system, count(*) FILTER (WHERE outcome = 'rejected_unit') AS rejected_unit, count(*) FILTER (WHERE outcome = 'rejected_non_numeric') AS rejected_non_numeric, count(*) FILTER (WHERE outcome = 'rejected_range') AS rejected_range FROM outcomes", _JUDGED))
def _(v):
    return rules.audit(rules.numeric_rule(v.ev, PRESSURE, code="code", value="raw_value", unit="unit"))


@query("op_D24_quality_counts", "SELECT 'customer' AS name, count(*) AS n FROM customer UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'events', count(*) FROM events")
def _(v):
    names = ("customer", "orders", "lineitem", "events")
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(n).alias("name"), "n") for n, df in zip(names, tables(v.spark, v.dir, *names))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query("op_D25_table_hash", sql("SELECT count(*) AS rows, 'encounter_id,state,subject_id,type' AS columns, CAST(sum(CAST('0x' || left(sha256(concat_ws(chr(31), coalesce(CAST(encounter_id AS VARCHAR), chr(30)), coalesce(state, chr(30)), coalesce(CAST(subject_id AS VARCHAR), chr(30)), coalesce(type, chr(30)))), 15) AS BIGINT)) AS VARCHAR) AS digest FROM enc"))
def _(v):
    return aggregate.table_hash(v.enc.select("encounter_id", "subject_id", "type", "state"))


@query("op_D26_distinct", sql("SELECT DISTINCT code, system FROM ev"))
def _(v):
    return v.ev.select("code", "system").distinct()


@query("op_D27_coverage", sql("SELECT source, strftime(min(t), '%Y-%m-%d') AS first_day, strftime(max(t), '%Y-%m-%d') AS last_day, count(t) AS n FROM (SELECT 'events' AS source, ts AS t FROM ev UNION ALL SELECT 'starts', start FROM enc UNION ALL SELECT 'ends', \"end\" FROM enc) GROUP BY 1"))
def _(v):
    return aggregate.coverage({"events": (v.ev, "ts"), "starts": (v.enc, "start"), "ends": (v.enc, "end")})


# ---- E: windows ------------------------------------------------------------------------


@query("op_E1_keep_first", sql("SELECT subject_id, encounter_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY subject_id, encounter_id ORDER BY ts, event_id) AS r FROM ev) WHERE r = 1"))
def _(v):
    return reduce.keep_first(v.ev, ["subject_id", "encounter_id"], [asc("ts"), asc("event_id")]).select("subject_id", "encounter_id", "event_id")


@query("op_E2_first_by_hash", sql("SELECT subject_id, id FROM (SELECT subject_id, sha256(concat_ws(chr(31), CAST(event_id AS VARCHAR), code)) AS id, row_number() OVER (PARTITION BY subject_id ORDER BY sha256(concat_ws(chr(31), CAST(event_id AS VARCHAR), code))) AS r FROM ev) WHERE r = 1"))
def _(v):
    hashed = v.ev.select("subject_id", scalar.record_id(F.col("event_id"), F.col("code")).alias("id"))
    return reduce.keep_first(hashed, ["subject_id"], [asc("id")])


@query("op_E3_first_then_check", sql("SELECT subject_id, event_id, coalesce(unit = 'mmHg', false) AS valid FROM (SELECT *, row_number() OVER (PARTITION BY subject_id ORDER BY ts, event_id) AS r FROM ev WHERE code = 'view') WHERE r = 1"))
def _(v):
    first = reduce.keep_first(v.ev.filter("code = 'view'"), ["subject_id"], [asc("ts"), asc("event_id")])
    return first.select("subject_id", "event_id", F.coalesce(F.col("unit") == "mmHg", F.lit(False)).alias("valid"))


@query("op_E5_qualify", sql("SELECT subject_id, encounter_id FROM enc WHERE type = 'EMER' QUALIFY row_number() OVER (PARTITION BY subject_id ORDER BY start, encounter_id) = 1"))
def _(v):
    return reduce.keep_first(v.enc.filter("type = 'EMER'"), ["subject_id"], [asc("start"), asc("encounter_id")]).select("subject_id", "encounter_id")


@query("op_E8_custom_rank", sql("SELECT subject_id, encounter_id FROM (SELECT *, row_number() OVER (PARTITION BY subject_id ORDER BY CASE WHEN type = 'AMB' THEN 0 ELSE 1 END, start DESC, encounter_id DESC) AS r FROM enc) WHERE r = 1"))
def _(v):
    order = [F.when(F.col("type") == "AMB", 0).otherwise(1).asc(), desc("start"), desc("encounter_id")]
    return reduce.keep_first(v.enc, ["subject_id"], order).select("subject_id", "encounter_id")


@query("op_E9_evidence_rank", sql("SELECT subject_id, event_id, CAST(row_number() OVER (PARTITION BY subject_id ORDER BY ts DESC, event_id) AS INTEGER) AS evidence_rank FROM ev WHERE code = 'error'"))
def _(v):
    return order.ranked_in_ranges(v.ev.filter("code = 'error'"), ["subject_id"], [desc("ts"), asc("event_id")], "evidence_rank").select("subject_id", "event_id", "evidence_rank")


_FLOW = """f AS (SELECT * FROM (VALUES (1, 'all', (SELECT count(*) FROM enc)), (2, 'typed', (SELECT count(*) FROM enc WHERE type <> 'OTHER')), (3, 'closed', (SELECT count(*) FROM enc WHERE type <> 'OTHER' AND "end" IS NOT NULL)), (4, 'valid', (SELECT count(*) FROM enc WHERE type <> 'OTHER' AND "end" >= start))) AS t(stage_order, stage, n))"""


@query("op_E10_lag_flow", sql("SELECT stage_order, stage, n, round(100.0 * n / lag(n) OVER (ORDER BY stage_order), 4) AS pct_previous, round(100.0 * n / first_value(n) OVER (ORDER BY stage_order), 4) AS pct_source FROM f", _FLOW))
def _(v):
    return aggregate.flow(v.enc, [("all", F.lit(True)), ("typed", F.col("type") != "OTHER"), ("closed", F.col("end").isNotNull()), ("valid", F.col("end") >= F.col("start"))])


@query("op_E11_topk_group", sql("SELECT system, code2, n, CAST(rank AS INTEGER) AS rank FROM (SELECT system, code2, count(*) AS n, row_number() OVER (PARTITION BY system ORDER BY count(*) DESC, code2) AS rank FROM ev GROUP BY 1, 2) WHERE rank <= 20"))
def _(v):
    return reduce.top_k(v.ev.groupBy("system", "code2").agg(F.count("*").alias("n")), ["system"], [desc("n"), asc("code2")], 20).select("system", "code2", "n", "rank")


_TWO = "SELECT subject_id, encounter_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY subject_id ORDER BY {outer}) AS q FROM (SELECT *, row_number() OVER (PARTITION BY subject_id, encounter_id ORDER BY {inner}) AS r FROM ev) WHERE r = 1) WHERE q = 1"


@query("op_E14_two_level_first", sql(_TWO.format(inner="ts, event_id", outer="ts, encounter_id, event_id")))
def _(v):
    return reduce.two_level_first(v.ev, patient="subject_id", encounter="encounter_id", ts="ts", tie="event_id").select("subject_id", "encounter_id", "event_id")


@query("op_E15_two_level_last", sql(_TWO.format(inner="date_trunc('day', ts) DESC, event_id DESC", outer="date_trunc('day', ts) DESC, encounter_id, event_id DESC")))
def _(v):
    daily = v.ev.withColumn("day", temporal.day(F.col("ts")))
    return reduce.two_level_last(daily, patient="subject_id", encounter="encounter_id", ts="day", tie="event_id").select("subject_id", "encounter_id", "event_id")


@query("op_E16_highest", sql(_TWO.format(inner="value DESC NULLS LAST, event_id", outer="value DESC NULLS LAST, encounter_id DESC, event_id")))
def _(v):
    return reduce.two_level_highest(v.ev, patient="subject_id", encounter="encounter_id", value="value", tie="event_id").select("subject_id", "encounter_id", "event_id")


@query("op_E17_code_priority", sql(_TWO.format(inner="date_trunc('day', ts), CASE code WHEN 'purchase' THEN 0 ELSE 1 END, event_id", outer="date_trunc('day', ts), encounter_id, CASE code WHEN 'purchase' THEN 0 ELSE 1 END, event_id")))
def _(v):
    daily = v.ev.withColumn("day", temporal.day(F.col("ts")))
    return reduce.two_level_first(daily, patient="subject_id", encounter="encounter_id", ts="day", tie="event_id", more=[F.when(F.col("code") == "purchase", 0).otherwise(1).asc()]).select("subject_id", "encounter_id", "event_id")


# ---- F, G: sorts and sets ------------------------------------------------------------------


@query("op_F4_topk", sql("SELECT subject_id, count(*) AS n FROM ev GROUP BY 1 ORDER BY n DESC, subject_id LIMIT 15"))
def _(v):
    return v.ev.groupBy("subject_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "subject_id").limit(15)


@query("op_F2_output_order", sql("SELECT subject_id, encounter_id FROM enc ORDER BY 1, 2"))
def _(v):
    return v.enc.select("subject_id", "encounter_id").orderBy("subject_id", "encounter_id")


@query("op_G1_union", sql("SELECT subject_id, 'vip' AS flag, balance > 5000 AS value FROM subj UNION ALL SELECT subject_id, 'female', sex = 'F' FROM subj UNION ALL SELECT subject_id, 'old', birth_year < 1950 FROM subj"))
def _(v):
    flags = v.subj.select("subject_id", (F.col("balance") > 5000).alias("vip"), (F.col("sex") == "F").alias("female"), (F.col("birth_year") < 1950).alias("old"))
    return aggregate.unpivot_flags(flags, ["subject_id"], ["vip", "female", "old"], "flag", "value")


@query("op_G2_tagged_union", sql("SELECT 'dx' AS source, event_id FROM ev WHERE code = 'click' UNION ALL SELECT 'vital', event_id FROM ev WHERE value > 25"))
def _(v):
    return v.ev.filter("code = 'click'").select(F.lit("dx").alias("source"), "event_id").unionByName(v.ev.filter("value > 25").select(F.lit("vital").alias("source"), "event_id"))


@query("op_G4_membership", sql("SELECT DISTINCT encounter_id FROM ev WHERE code = 'click' OR value > 25"))
def _(v):
    return v.ev.filter("code = 'click'").select("encounter_id").union(v.ev.filter("value > 25").select("encounter_id")).distinct()


@query("op_G5_key_compare", sql("SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'missing' WHEN a.k IS NULL THEN 'extra' WHEN a.n <> b.n THEN 'mismatched' ELSE 'same' END AS outcome FROM (SELECT code2 AS k, count(*) AS n FROM ev WHERE code <> 'error' GROUP BY 1) a FULL JOIN (SELECT code2 AS k, count(*) AS n FROM ev WHERE event_id % 7 <> 0 AND code <> 'signup' GROUP BY 1) b ON a.k = b.k"))
def _(v):
    count = lambda df: df.groupBy(F.col("code2").alias("k")).agg(F.count("*").alias("n"))
    return joins.compare_keys(count(v.ev.filter("code <> 'error'")), count(v.ev.filter("event_id % 7 <> 0 AND code <> 'signup'")), ["k"], "n")


# ---- H: scalars -----------------------------------------------------------------------------


@query("op_H_strings", sql("SELECT event_id, lower(trim(coalesce(unit, ''))) AS unit, concat_ws('-', code, unit, system) AS joined, code || unit AS chained, replace(code, 'e', '') AS replaced, nullif(trim(system), 'LOINC') AS nulled, length(code) AS n, regexp_matches(code2, '^[VP]') AS hit, regexp_full_match(code2, 'V1[0-9]') AS whole FROM ev"))
def _(v):
    return v.ev.select(
        "event_id", scalar.norm_text(F.col("unit")).alias("unit"), F.concat_ws("-", "code", "unit", "system").alias("joined"), F.concat("code", "unit").alias("chained"), F.replace("code", F.lit("e"), F.lit("")).alias("replaced"),
        F.nullif(F.trim("system"), F.lit("LOINC")).alias("nulled"), F.length("code").cast("bigint").alias("n"), F.col("code2").rlike("^[VP]").alias("hit"), scalar.full_match(F.col("code2"), "V1[0-9]").alias("whole"),
    )


@query("op_H_record_id", sql("SELECT event_id, sha256(concat_ws(chr(31), code, unit, system)) AS id FROM ev"))
def _(v):
    return v.ev.select("event_id", scalar.record_id(F.col("code"), F.col("unit"), F.col("system")).alias("id"))


@query("op_H_numbers", sql("SELECT event_id, TRY_CAST(raw_value AS DOUBLE) AS num, round(sqrt(value) + power(value, 2) + abs(-value), 6) AS mix, greatest(value, CASE WHEN event_id % 4 = 2 THEN NULL ELSE 20.0 END) AS top, least(value, 20.0) AS low, round(40 * value / (250 * sqrt(value + 1)), 8) AS fib, round(CASE WHEN value < 43.3 THEN value * 9 / 5 + 32 ELSE value END, 6) AS f FROM ev"))
def _(v):
    x = F.col("value")
    return v.ev.select(
        "event_id", scalar.number(F.col("raw_value")).alias("num"), F.round(F.sqrt(x) + F.pow(x, 2) + F.abs(-x), 6).alias("mix"), F.greatest(x, F.when(F.col("unit").isNull(), F.lit(None)).otherwise(20.0)).alias("top"), F.least(x, F.lit(20.0)).alias("low"),
        F.round(scalar.fib4(F.lit(40), x, x + 1, F.lit(250)), 8).alias("fib"), F.round(scalar.to_fahrenheit(x), 6).alias("f"),
    )


@query("op_H_dates", sql(f"SELECT event_id, CASE WHEN raw_ts = 'bad' THEN NULL WHEN length(raw_ts) = 8 THEN strftime(strptime(raw_ts, '%Y%m%d'), {TS}) ELSE strftime(CAST(raw_ts AS TIMESTAMP), {TS}) END AS parsed, CASE WHEN regexp_full_match(raw_ts, '[0-9]{{8}}|[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN 'date_only' ELSE 'timestamp' END AS precision, CAST(year(ts) AS INTEGER) AS y, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS d FROM ev"))
def _(v):
    return v.ev.select("event_id", temporal.iso_second(temporal.parse_timestamp(F.col("raw_ts"))).alias("parsed"), temporal.precision(F.col("raw_ts")).alias("precision"), F.year("ts").alias("y"), temporal.iso_date(F.to_date("ts")).alias("d"))


@query("op_H_datediff", sql("SELECT event_id, date_diff('day', TIMESTAMP '2024-01-05 13:30:30', ts) AS days, date_diff('hour', TIMESTAMP '2024-01-05 13:30:30', ts) AS hours, date_diff('minute', TIMESTAMP '2024-01-05 13:30:30', ts) AS minutes, date_diff('second', TIMESTAMP '2024-01-05 13:30:30', ts) AS seconds FROM ev"))
def _(v):
    a = F.lit("2024-01-05 13:30:30").cast("timestamp_ntz")
    return v.ev.select("event_id", *[temporal.boundaries(u, a, F.col("ts")).alias(f"{u}s") for u in ("day", "hour", "minute", "second")])


@query("op_H_separation", sql("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN date_trunc('day', ts) >= TIMESTAMP '2024-01-05' + INTERVAL 10 DAY ELSE ts >= TIMESTAMP '2024-01-05 13:30:30' + INTERVAL 10 DAY END AS apart FROM ev"))
def _(v):
    kind = F.when(F.col("event_id") % 2 == 0, temporal.DATE_ONLY).otherwise(temporal.TIMESTAMP)
    return v.ev.select("event_id", temporal.separated(F.lit("2024-01-05 13:30:30").cast("timestamp_ntz"), F.lit(temporal.TIMESTAMP), F.col("ts"), kind, 10).alias("apart"))


@query("op_H_json", sql("""SELECT event_id, '{"code":"' || code || '","unit":' || CASE WHEN unit IS NULL THEN 'null' ELSE '"' || unit || '"' END || ',"subject":' || CAST(subject_id AS VARCHAR) || '}' AS provenance, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM ev"""))
def _(v):
    return v.ev.select("event_id", scalar.json_object(code=F.col("code"), unit=F.col("unit"), subject=F.col("subject_id")).alias("provenance"), F.get_json_object("props", "$.k").cast("bigint").alias("k"))


@query("op_H_hash_bucket", "SELECT count(*) AS n, count(DISTINCT event_id) AS ids, CAST(16 AS BIGINT) AS buckets, CAST(0 AS INTEGER) AS low, CAST(15 AS INTEGER) AS high FROM events")
def _(v):
    # any function of the key to 16 buckets passes; one that splits a key, leaves a bucket empty or goes beyond them doesn't
    each = v.ev.groupBy(scalar.bucket(F.col("event_id"), 16).alias("b")).agg(F.count("*").alias("c"), F.count_distinct("event_id").alias("k"))
    return each.agg(F.sum("c").alias("n"), F.sum("k").alias("ids"), F.count("*").alias("buckets"), F.min("b").alias("low"), F.max("b").alias("high"))


@query("op_J1_status", sql("SELECT subject_id, CASE WHEN balance > 5000 THEN 'met' ELSE 'indeterminate' END AS rich FROM subj"))
def _(v):
    return v.subj.select("subject_id", scalar.status(F.col("balance") > 5000).alias("rich"))
