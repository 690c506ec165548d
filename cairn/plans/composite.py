"""Composite queries: cohorts, features, index events, statuses, ledgers, quality, sinks and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cairn import shared
from cairn.functions import scalar, temporal
from cairn.operators import aggregate, cohort, joins, reduce, rules
from cairn.operators.reduce import asc, desc
from cairn.plans.registry import query
from cairn.plans.relational import _INDEX, _SHIFT, TS, _enc24, _index, sec
from cairn.plans.roles import PRESSURE, RULES, RULES_CTE, UNITS, sql, sql_rule_match, tables


def scratch(v, tag: str) -> str:
    """A fresh folder that all executors see."""
    return shared.fresh_path(v.spark, tag)


# ---- K1..K6: events, flags, cohorts, encounters ---------------------------------------------------

_EVENTS = """k AS (SELECT 'gas' AS category, event_id, subject_id, encounter_id, ts FROM ev WHERE code IN ('view', 'purchase') AND CASE lower(trim(coalesce(unit, ''))) WHEN 'mmhg' THEN 1.0 WHEN 'kpa' THEN 7.5006168270417 END * TRY_CAST(raw_value AS DOUBLE) > 45
   AND CASE lower(trim(coalesce(unit, ''))) WHEN 'mmhg' THEN 1.0 WHEN 'kpa' THEN 7.5006168270417 END * TRY_CAST(raw_value AS DOUBLE) < 200
  UNION ALL SELECT 'dx', event_id, subject_id, encounter_id, ts FROM ev WHERE starts_with(code2, 'P1')
  UNION ALL SELECT 'px', event_id, subject_id, encounter_id, ts FROM ev WHERE code = 'error' AND value > 20)"""


def category_events(v):
    """Qualifying events of three categories, from rules of each kind."""
    cols = ["event_id", "subject_id", "encounter_id", "ts"]
    gas = rules.numeric_rule(v.ev, PRESSURE, code="code", value="raw_value", unit="unit").filter("outcome = 'accepted'")
    dx = v.ev.filter(rules.CodeRule("dx", (), ("P1",)).mask(F.col("code2")))
    px = v.ev.filter("code = 'error' AND value > 20")
    return [df.select(F.lit(name).alias("category"), *cols) for name, df in (("gas", gas), ("dx", dx), ("px", px))]


@query("op_K1_rfs_events", sql("SELECT category, count(*) AS n, count(DISTINCT subject_id) AS subjects FROM k GROUP BY 1", _EVENTS))
def _(v):
    a, b, c = category_events(v)
    return a.unionByName(b).unionByName(c).groupBy("category").agg(F.count("*").alias("n"), F.count_distinct("subject_id").alias("subjects"))


@query("op_K2_domain_events", sql("SELECT category, event_id FROM k WHERE category <> 'gas'", _EVENTS))
def _(v):
    _, b, c = category_events(v)
    return b.unionByName(c).select("category", "event_id")


@query("op_K3_encounter_flags", sql("SELECT n.encounter_id, coalesce(gas, false) AS gas, coalesce(dx, false) AS dx, coalesce(px, false) AS px FROM enc n LEFT JOIN (SELECT encounter_id, bool_or(category = 'gas') AS gas, bool_or(category = 'dx') AS dx, bool_or(category = 'px') AS px FROM k GROUP BY 1) USING (encounter_id)", _EVENTS))
def _(v):
    a, b, c = category_events(v)
    return cohort.encounter_flags(v.enc.select("encounter_id"), {"gas": a, "dx": b, "px": c})


_CAND = _EVENTS + ", cand AS (SELECT k.*, s.birth_year, s.region FROM k JOIN subj s USING (subject_id) WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-25' AND region NOT IN ('ASIA', 'MIDDLE EAST'))"


def candidates(v):
    a, b, c = category_events(v)
    return cohort.event_candidates(a.unionByName(b).unionByName(c), v.subj, first="2024-01-05", last="2024-01-25", excluded_regions=["ASIA", "MIDDLE EAST"])


@query("op_K4_event_candidates", sql("SELECT category, event_id, region FROM cand", _CAND))
def _(v):
    return candidates(v).select("category", "event_id", "region")


@query("op_K5_cohort", sql("SELECT category, type, subject_id, event_id, encounter_id FROM (SELECT c.category, n.type, c.subject_id, c.event_id, n.encounter_id, row_number() OVER (PARTITION BY c.subject_id, c.category, n.type ORDER BY c.ts, c.event_id, n.encounter_id) AS r FROM cand c JOIN enc24 n ON n.subject_id = c.subject_id AND c.ts >= n.start AND c.ts <= n.stop WHERE year(c.ts) - birth_year >= 18 AND year(c.ts) - birth_year < 110) WHERE r = 1", _CAND, _SHIFT))
def _(v):
    enc = _enc24(v).withColumnRenamed("stop", "end")
    return cohort.cohort(candidates(v).drop("encounter_id"), enc).select("category", "type", "subject_id", "event_id", "encounter_id")


@query("op_K6_encounters", sql("""SELECT encounter_id, type, los FROM (SELECT encounter_id, type, CAST(floor(date_diff('second', start, coalesce("end", TIMESTAMP '2001-12-31')) / 86400.0) AS BIGINT) + 1 AS los FROM (SELECT *, row_number() OVER (PARTITION BY encounter_id ORDER BY start, type) AS r FROM (SELECT * FROM enc UNION ALL SELECT encounter_id, subject_id, start - INTERVAL 1 DAY, start - INTERVAL 9 DAY, 'IMP', cost, state FROM enc WHERE encounter_id % 10 = 0) WHERE type IN ('AMB','EMER','IMP') AND start >= TIMESTAMP '1999-01-01') WHERE r = 1) WHERE los > 0"""))
def _(v):
    twin = v.enc.filter("encounter_id % 10 = 0").select("encounter_id", "subject_id", (F.col("start") - F.expr("INTERVAL '1' DAY")).alias("start"), (F.col("start") - F.expr("INTERVAL '9' DAY")).alias("end"), F.lit("IMP").alias("type"), "cost", "state")
    out = cohort.reduce_encounters(v.enc.unionByName(twin), types=["AMB", "EMER", "IMP"], not_before="1999-01-01", end_default="2001-12-31", order=[asc("start"), asc("type")])
    return out.select("encounter_id", "type", "los")


# ---- K7..K14: features -----------------------------------------------------------------------------

_FIRSTS = "firsts AS (SELECT subject_id, code, value, ts FROM (SELECT *, row_number() OVER (PARTITION BY subject_id, code ORDER BY ts, encounter_id, event_id) AS q FROM (SELECT *, row_number() OVER (PARTITION BY subject_id, encounter_id, code ORDER BY ts, event_id) AS r FROM ev) WHERE r = 1) WHERE q = 1)"


@query("op_K7_vital_features", sql("SELECT subject_id, max(value) FILTER (WHERE code = 'view') AS value_view, strftime(max(ts) FILTER (WHERE code = 'view'), '%Y-%m-%d') AS date_view, max(value) FILTER (WHERE code = 'click') AS value_click, strftime(max(ts) FILTER (WHERE code = 'click'), '%Y-%m-%d') AS date_click FROM firsts GROUP BY 1", _FIRSTS))
def _(v):
    return cohort.wide_features(cohort.first_features(v.ev), ["view", "click"])


@query("op_K8_previous_values", sql("SELECT index_id, p.event_id AS prev_id, p.value AS prev_value FROM idx LEFT JOIN LATERAL (SELECT event_id, value FROM ev WHERE ev.subject_id = idx.subject_id AND ts < index_ts AND encounter_id NOT IN (SELECT encounter_id FROM ev WHERE event_id IN (SELECT index_id FROM idx)) ORDER BY ts DESC, event_id DESC LIMIT 1) p ON true", _INDEX))
def _(v):
    index = _index(v).join(v.ev.select(F.col("event_id").alias("index_id"), "encounter_id"), "index_id")
    return cohort.previous_value(index, v.ev).select("index_id", "prev_id", "prev_value")


@query("op_K9_highest_features", sql("SELECT subject_id, code, value FROM (SELECT *, row_number() OVER (PARTITION BY subject_id, code ORDER BY value DESC NULLS LAST, event_id) AS r FROM ev) WHERE r = 1"))
def _(v):
    return reduce.keep_first(v.ev, ["subject_id", "code"], [desc("value"), asc("event_id")]).select("subject_id", "code", "value")


@query("op_K10_current_diagnosis", sql("SELECT subject_id, code, true AS has, state FROM (SELECT e.subject_id, e.code, n.state, row_number() OVER (PARTITION BY e.subject_id, e.code ORDER BY CASE n.state WHEN 'P' THEN 3 WHEN 'F' THEN 2 WHEN 'O' THEN 1 END DESC, e.event_id) AS r FROM ev e JOIN enc n USING (encounter_id)) WHERE r = 1"))
def _(v):
    tagged = v.ev.join(v.enc.select("encounter_id", "state"), "encounter_id")
    return tagged.groupBy("subject_id", "code").agg(F.lit(True).alias("has"), reduce.by_priority("state", {"P": 3, "F": 2, "O": 1}, "event_id").alias("state"))


_PRIOR = "SELECT index_id, code, true AS has, strftime(min(ts), '%Y-%m-%d') AS first_date, strftime(max(ts), '%Y-%m-%d') AS last_date FROM idx JOIN ev USING (subject_id) WHERE {test} GROUP BY 1, 2"


@query("op_K11_prior_diagnosis", sql(_PRIOR.format(test="ts <= index_ts"), _INDEX))
def _(v):
    hits = joins.within(_index(v), v.ev.select("subject_id", "code", "ts"), ["subject_id"], F.col("ts") <= F.col("index_ts"))
    return cohort.first_last_dates(hits, ["index_id"], "ts", "code")


@query("op_K12_procedures", sql("SELECT encounter_id, code, true AS has, strftime(min(ts), '%Y-%m-%d') AS first_date, strftime(max(ts), '%Y-%m-%d') AS last_date FROM ev WHERE code IN ('error', 'signup') GROUP BY 1, 2"))
def _(v):
    return cohort.first_last_dates(v.ev.filter(F.col("code").isin("error", "signup")), ["encounter_id"], "ts", "code")


@query("op_K13_medications", sql(_PRIOR.format(test="ts > index_ts AND code <> 'purchase'"), _INDEX))
def _(v):
    hits = joins.within(_index(v), v.ev.filter("code <> 'purchase'").select("subject_id", "code", "ts"), ["subject_id"], F.col("ts") > F.col("index_ts"))
    return cohort.first_last_dates(hits, ["index_id"], "ts", "code")


@query("op_K14_data_screen", sql("SELECT encounter_id FROM enc WHERE encounter_id IN (SELECT encounter_id FROM ev WHERE code = 'signup') OR encounter_id IN (SELECT encounter_id FROM ev WHERE code = 'error' AND value > 15)"))
def _(v):
    return joins.semi_either(v.enc.withColumn("_again", F.col("encounter_id")), ("encounter_id", v.ev.filter("code = 'signup'"), "encounter_id"), ("_again", v.ev.filter("code = 'error' AND value > 15"), "encounter_id")).select("encounter_id")


@query("op_K14_labels_screen", "SELECT d.source, count(*) AS n FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1) GROUP BY 1")
def _(v):
    d, lab = tables(v.spark, v.dir, "documents", "labels")
    return joins.semi(d.select("doc_id", "source"), lab.filter("quality = 1"), ["doc_id"]).groupBy("source").agg(F.count("*").alias("n"))


@query("op_B30_finalise", sql("SELECT s.subject_id AS patient_id, CAST(coalesce(x.n, 0) AS INTEGER) AS n_events, coalesce(s.region, '') AS region, CAST(NULL AS DOUBLE) AS bmi FROM subj s LEFT JOIN (SELECT subject_id, count(*) AS n FROM ev GROUP BY 1) x USING (subject_id)"))
def _(v):
    wide = joins.left_all(v.subj, [v.ev.groupBy("subject_id").agg(F.count("*").alias("n_events"))], ["subject_id"])
    return cohort.finalise(wide, [("patient_id", "bigint", None), ("n_events", "int", 0), ("region", "string", ""), ("bmi", "double", None)], ["patient_id"], {"subject_id": "patient_id"})


@query("op_B32_screen_filter", sql("SELECT event_id FROM ev WHERE encounter_id IN (SELECT encounter_id FROM enc WHERE type <> 'OTHER')"))
def _(v):
    return joins.semi(v.ev, v.enc.filter("type <> 'OTHER'"), ["encounter_id"]).select("event_id")


# ---- K15..K22: measurements, index events, phenotypes ---------------------------------------------------


@query("op_K15_normalised_measurements", sql("SELECT r.rule, e.event_id, round(TRY_CAST(e.raw_value AS DOUBLE) * CASE lower(trim(coalesce(e.unit, ''))) WHEN 'mmhg' THEN 1.0 WHEN 'kpa' THEN 7.5006168270417 WHEN '' THEN 1.0 END, 6) AS value_std FROM ev e JOIN (SELECT DISTINCT * FROM rules) r ON " + sql_rule_match() + " GROUP BY ALL", RULES_CTE))
def _(v):
    hits = rules.match_codes(v.ev, rules.catalog(v.spark, RULES), code="code2", system="system")
    return rules.normalise_units(hits, value="raw_value", unit="unit", factors=UNITS, low=10, high=250).select("rule", "event_id", F.round("value_std", 6).alias("value_std"))


_CANDS = "SELECT n.encounter_id, a.event_id AS first_event, CASE WHEN a.event_id IS NULL THEN 'no_event' WHEN a.unit IS NULL THEN 'no_unit' WHEN a.value <= 10 THEN 'normal' WHEN n.type = 'OTHER' THEN 'setting' END AS reason FROM enc24 n LEFT JOIN (SELECT * FROM (SELECT n.encounter_id AS eid, e.event_id, e.unit, e.value, row_number() OVER (PARTITION BY n.encounter_id ORDER BY e.ts, e.event_id) AS r FROM enc24 n JOIN ev e ON e.subject_id = n.subject_id AND e.ts >= n.start AND e.ts <= n.stop) WHERE r = 1) a ON a.eid = n.encounter_id"


@query("op_K16_candidate_cohort", sql(f"SELECT encounter_id, first_event, reason, CASE WHEN reason IS NULL THEN 'included' ELSE 'excluded' END AS status FROM ({_CANDS})", _SHIFT))
def _(v):
    enc = _enc24(v)
    inside = joins.within(enc, v.ev.select("subject_id", "event_id", "ts", "unit", "value"), ["subject_id"], (F.col("ts") >= F.col("start")) & (F.col("ts") <= F.col("stop")))
    # the first result is chosen before it is checked: later valid ones are not promoted
    first = inside.groupBy("encounter_id").agg(F.min_by(F.struct("event_id", "unit", "value"), F.struct("ts", "event_id")).alias("a")).select("encounter_id", F.col("a.event_id").alias("first_event"), "a.unit", "a.value")
    judged = cohort.candidate_status(enc.join(first, "encounter_id", "left"), [(F.col("first_event").isNull(), "no_event"), (F.col("unit").isNull(), "no_unit"), (F.col("value") <= 10, "normal"), (F.col("type") == "OTHER", "setting")])
    return judged.select("encounter_id", "first_event", "reason", "status")


@query("op_K17_index_events", sql(f"SELECT i.index_id, i.subject_id, strftime(index_ts, {TS}) AS index_ts, f.event_id AS follow_id, f.event_id IS NOT NULL AS persistent, s.region, CASE WHEN f.event_id IS NOT NULL THEN 'confirmed' WHEN s.birth_year < 1950 THEN 'watch' ELSE 'single' END AS status FROM (SELECT event_id AS index_id, subject_id, ts AS index_ts FROM (SELECT *, row_number() OVER (PARTITION BY subject_id ORDER BY ts, event_id) AS r FROM ev WHERE code = 'purchase' AND value > 10) WHERE r = 1) i LEFT JOIN LATERAL (SELECT event_id FROM ev WHERE ev.subject_id = i.subject_id AND code = 'purchase' AND value > 10 AND ts >= index_ts + INTERVAL 1 DAY AND ts <= index_ts + INTERVAL 14 DAY ORDER BY ts, event_id LIMIT 1) f ON true LEFT JOIN subj s USING (subject_id)"))
def _(v):
    high = v.ev.filter("code = 'purchase' AND value > 10")
    found = cohort.index_events(high, high, first_days=1, last_days=14)
    out = joins.guarded_left(found, v.subj, ["subject_id"], strict=False)
    status = cohort.ladder((F.col("persistent"), "confirmed"), (F.col("birth_year") < 1950, "watch"), otherwise="single")
    return out.select("index_id", "subject_id", sec("index_ts"), "follow_id", "persistent", "region", status.alias("status"))


@query("op_K18_measure_choice", sql("SELECT index_id, event_id, source_rank FROM (SELECT index_id, e.event_id, CASE e.code WHEN 'view' THEN 1 WHEN 'click' THEN 2 ELSE 3 END AS source_rank, row_number() OVER (PARTITION BY index_id ORDER BY CASE e.code WHEN 'view' THEN 1 WHEN 'click' THEN 2 ELSE 3 END, abs(date_diff('second', index_ts, e.ts)), e.event_id) AS r FROM idx JOIN ev e USING (subject_id) WHERE e.code <> 'purchase' AND e.value BETWEEN 10 AND 100) WHERE r = 1", _INDEX))
def _(v):
    rank = F.when(F.col("code") == "view", 1).when(F.col("code") == "click", 2).otherwise(3)
    measures = v.ev.filter("code <> 'purchase' AND value BETWEEN 10 AND 100").select("subject_id", "event_id", "ts", rank.alias("source_rank"))
    return cohort.choose_measure(_index(v), measures, ["subject_id"], index_id="index_id", index_ts="index_ts", ts="ts", rank="source_rank", tie="event_id").select("index_id", "event_id", "source_rank")


@query("op_K19_context_flags", sql("SELECT index_id, coalesce(b.error, false) AS error, coalesce(b.signup, false) AS signup FROM idx LEFT JOIN (SELECT index_id, bool_or(code = 'error') AS error, bool_or(code = 'signup') AS signup FROM idx JOIN ev USING (subject_id) WHERE ts >= index_ts - INTERVAL 1 DAY AND ts <= index_ts + INTERVAL 1 DAY GROUP BY 1) b USING (index_id)", _INDEX))
def _(v):
    index = _index(v)
    near = joins.within(index, v.ev.select("subject_id", "code", "ts"), ["subject_id"], (F.col("ts") >= temporal.days_from(F.col("index_ts"), -1)) & (F.col("ts") <= temporal.days_from(F.col("index_ts"), 1)))
    flags = aggregate.flag_pivot(near, ["index_id"], "code", ["error", "signup"])
    base = index.select("index_id", F.lit(False).alias("error"), F.lit(False).alias("signup"))
    return joins.merge_update(base, flags, ["index_id"], ["error", "signup"])


_COMP = "comp AS (SELECT index_id, count(*) FILTER (WHERE code = 'view') AS n_view, max(value) FILTER (WHERE code = 'click') AS top_click, first(value ORDER BY ts DESC, event_id DESC) FILTER (WHERE code = 'view') AS latest_view, count(DISTINCT encounter_id) FILTER (WHERE code = 'error') AS error_encounters FROM idx JOIN ev USING (subject_id) WHERE ts <= index_ts + INTERVAL 10 DAY GROUP BY 1)"


def components(v):
    hits = joins.within(_index(v), v.ev.select("subject_id", "event_id", "encounter_id", "code", "value", "ts"), ["subject_id"], F.col("ts") <= temporal.days_from(F.col("index_ts"), 10))
    return hits.groupBy("index_id").agg(
        F.count_if(F.col("code") == "view").alias("n_view"), aggregate.max_where("value", F.col("code") == "click").alias("top_click"),
        reduce.last_value("value", "ts", "event_id", where=F.col("code") == "view").alias("latest_view"), aggregate.distinct_where("encounter_id", F.col("code") == "error").alias("error_encounters"),
    )


@query("op_K20_component_summary", sql("SELECT * FROM comp", _INDEX, _COMP))
def _(v):
    return components(v)


_STATUS = "st AS (SELECT index_id, CASE WHEN top_click > 30 THEN 'met' ELSE 'indeterminate' END AS click_status, CASE WHEN n_view >= 3 THEN 'met' ELSE 'indeterminate' END AS view_status, CASE WHEN latest_view > 40 THEN 'severe' WHEN latest_view > 10 THEN 'mild' WHEN error_encounters > 0 THEN 'coded' ELSE 'indeterminate' END AS severity, CASE WHEN top_click > 30 THEN true END AS i_click, CASE WHEN latest_view > 10 THEN true END AS i_view, CASE WHEN error_encounters > 0 THEN true END AS i_error FROM comp)"


def phenotypes(v):
    base = cohort.statuses(components(v), {"click": F.col("top_click") > 30, "view": F.col("n_view") >= 3})
    base = base.withColumn("severity", cohort.ladder((F.col("latest_view") > 40, "severe"), (F.col("latest_view") > 10, "mild"), (F.col("error_encounters") > 0, "coded")))
    return cohort.tiers(base, {"i_click": F.col("top_click") > 30, "i_view": F.col("latest_view") > 10, "i_error": F.col("error_encounters") > 0})


@query("op_K21_statuses", sql("SELECT index_id, click_status, view_status, severity FROM st", _INDEX, _COMP, _STATUS))
def _(v):
    return phenotypes(v).select("index_id", "click_status", "view_status", "severity")


@query("op_K22_tiers", sql("SELECT index_id, i_click, i_view, i_error, coalesce(i_click, i_view, i_error) AS any_indication, CAST(coalesce(i_click, false) AS BIGINT) + CAST(coalesce(i_view, false) AS BIGINT) + CAST(coalesce(i_error, false) AS BIGINT) AS n_indications FROM st", _INDEX, _COMP, _STATUS))
def _(v):
    return phenotypes(v).select("index_id", "i_click", "i_view", "i_error", "any_indication", "n_indications")


# ---- K23..K26: ledger, views, flow -----------------------------------------------------------------------


@query("op_K23_evidence", sql("SELECT subject_id, domain, event_id, CAST(row_number() OVER (PARTITION BY subject_id, domain ORDER BY ts DESC, event_id) AS INTEGER) AS evidence_rank FROM (SELECT subject_id, 'dx' AS domain, event_id, ts FROM ev WHERE code = 'click' UNION ALL SELECT subject_id, 'lab', event_id, ts FROM ev WHERE code = 'purchase' AND value > 20)"))
def _(v):
    ledger = cohort.evidence({"dx": v.ev.filter("code = 'click'"), "lab": v.ev.filter("code = 'purchase' AND value > 20")}, key="subject_id", ts="ts", tie="event_id", columns=["value"])
    return ledger.select("subject_id", "domain", "event_id", "evidence_rank")


_PREV = "SELECT '{f}' AS flag, count(*) FILTER (WHERE {f}) AS met, {den} AS denominator, round(100.0 * count(*) FILTER (WHERE {f}) / {den}, 4) AS pct FROM st"


@query("op_K24_prevalence", sql(" UNION ALL ".join(_PREV.format(f=f, den="count(*)") for f in ("i_click", "i_view", "i_error")), _INDEX, _COMP, _STATUS))
def _(v):
    return aggregate.prevalence(phenotypes(v), ["i_click", "i_view", "i_error"])


@query("op_K24_evaluable", sql(" UNION ALL ".join(_PREV.format(f=f, den=f"count({f})") for f in ("i_click", "i_view", "i_error")), _INDEX, _COMP, _STATUS))
def _(v):
    return aggregate.prevalence(phenotypes(v), ["i_click", "i_view", "i_error"], evaluable=True)


@query("op_K24_overlap", sql("SELECT combination, count(*) AS n FROM (SELECT coalesce(nullif(concat_ws('+', CASE WHEN i_click THEN 'i_click' END, CASE WHEN i_view THEN 'i_view' END, CASE WHEN i_error THEN 'i_error' END), ''), 'none') AS combination FROM st) GROUP BY 1", _INDEX, _COMP, _STATUS))
def _(v):
    return cohort.overlap(phenotypes(v), ["i_click", "i_view", "i_error"])


@query("op_K24_missingness", sql(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS missing, count(*) AS total, round(100.0 * count(*) FILTER (WHERE {c} IS NULL) / count(*), 4) AS pct_missing FROM comp" for c in ("top_click", "latest_view")), _INDEX, _COMP))
def _(v):
    return aggregate.missingness(components(v), ["top_click", "latest_view"])


@query("op_K24_treatment_gap", sql("SELECT i_click AS indicated, count(*) AS n, count(*) FILTER (WHERE error_encounters = 0) AS untreated FROM st JOIN comp USING (index_id) GROUP BY 1", _INDEX, _COMP, _STATUS))
def _(v):
    return phenotypes(v).groupBy(F.col("i_click").alias("indicated")).agg(F.count("*").alias("n"), F.count_if(F.col("error_encounters") == 0).alias("untreated"))


_STEPS = ["true", "region <> 'ASIA'", "birth_year BETWEEN 1930 AND 2000", "balance > 0", "sex = 'F'"]
_KFLOW = "f AS (" + " UNION ALL ".join(f"SELECT {i + 1} AS stage_order, 's{i + 1}' AS stage, count(*) AS n FROM subj WHERE {' AND '.join(_STEPS[: i + 1])}" for i in range(len(_STEPS))) + ")"


@query("op_K25_flow", sql("SELECT CAST(stage_order AS INTEGER) AS stage_order, stage, n, round(100.0 * n / lag(n) OVER (ORDER BY stage_order), 4) AS pct_previous, round(100.0 * n / first_value(n) OVER (ORDER BY stage_order), 4) AS pct_source FROM f", _KFLOW))
def _(v):
    return aggregate.flow(v.subj, [(f"s{i + 1}", F.expr(t)) for i, t in enumerate(_STEPS)])


@query("op_K26_source_flow", sql("SELECT count(*) AS rows, count(DISTINCT subject_id) AS subjects, count(DISTINCT (subject_id, encounter_id)) AS encounters FROM ev"))
def _(v):
    return v.ev.agg(F.count("*").alias("rows"), F.count_distinct("subject_id").alias("subjects"), aggregate.tuple_distinct("subject_id", "encounter_id").alias("encounters"))


# ---- K27..K34: capture, quality, comparison -----------------------------------------------------------------


@query("op_K27_filtered_ingestion", sql("SELECT event_id, sha256(concat_ws(chr(31), 'events', CAST(event_id AS VARCHAR), code2)) AS record_hash FROM ev e WHERE subject_id IN (SELECT subject_id FROM subj WHERE region = 'EUROPE') AND EXISTS (SELECT 1 FROM rules r WHERE " + sql_rule_match() + ")", RULES_CTE))
def _(v):
    kept = v.ev.filter(rules.predicate([(s, c, m) for _, _, s, c, m, on in RULES if on], F.col("code2"), F.col("system")))
    return joins.semi(kept, v.subj.filter("region = 'EUROPE'"), ["subject_id"]).select("event_id", scalar.record_id(F.lit("events"), F.col("event_id"), F.col("code2")).alias("record_hash"))


@query("op_K28_capture", sql("SELECT e.event_id, count(DISTINCT r.rule) AS elements FROM ev e LEFT JOIN rules r ON " + sql_rule_match() + " GROUP BY 1", RULES_CTE))
def _(v):
    hits = rules.match_codes(v.ev, rules.catalog(v.spark, RULES), code="code2", system="system", how="left")
    return hits.groupBy("event_id").agg(F.count_distinct("rule").alias("elements"))


@query("op_K29_terminology_qa", sql("SELECT r.rule, coalesce(m.n, 0) AS matches, coalesce(m.n, 0) = 0 AS missing FROM (SELECT DISTINCT rule FROM rules) r LEFT JOIN (SELECT r.rule, count(DISTINCT e.event_id) AS n FROM ev e JOIN rules r ON " + sql_rule_match() + " GROUP BY 1) m USING (rule)", RULES_CTE))
def _(v):
    cat = rules.catalog(v.spark, RULES)
    hits = rules.match_codes(v.ev, cat, code="code2", system="system").groupBy("rule").agg(F.count_distinct("event_id").alias("n"))
    out = cat.select("rule").distinct().join(hits, "rule", "left").select("rule", F.coalesce("n", F.lit(0)).alias("matches"))
    return out.withColumn("missing", F.col("matches") == 0)


@query("op_K29_unmapped_codes", sql("SELECT code2, count(*) AS n FROM ev e WHERE NOT EXISTS (SELECT 1 FROM rules r WHERE " + sql_rule_match() + ") GROUP BY 1 ORDER BY n DESC, code2 LIMIT 20", RULES_CTE))
def _(v):
    hits = rules.match_codes(v.ev, rules.catalog(v.spark, RULES), code="code2", system="system", how="left").filter("rule is null")
    return hits.groupBy("code2").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "code2").limit(20)


@query("op_K30_validation", sql("""SELECT 'orphan_event' AS error, count(*) AS n FROM ev WHERE subject_id NOT IN (SELECT subject_id FROM subj) UNION ALL SELECT 'duplicate_line', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) UNION ALL SELECT 'end_before_start', count(*) FROM enc WHERE "end" < start UNION ALL SELECT 'open_encounter', count(*) FROM enc WHERE "end" IS NULL"""))
def _(v):
    from cairn.operators.quality import validate

    (li,) = tables(v.spark, v.dir, "lineitem")
    return validate({
        "orphan_event": joins.anti(v.ev, v.subj, ["subject_id"]), "duplicate_line": aggregate.surplus_keys(li, ["l_orderkey", "l_linenumber"]),
        "end_before_start": v.enc.filter(F.col("end") < F.col("start")), "open_encounter": v.enc.filter(F.col("end").isNull()),
    })


@query("op_K31_adapter_exists", sql("SELECT encounter_id, type FROM enc n WHERE EXISTS (SELECT 1 FROM ev e WHERE e.encounter_id = n.encounter_id AND e.code = 'error')"))
def _(v):
    return joins.semi(v.enc, v.ev.filter("code = 'error'"), ["encounter_id"]).select("encounter_id", "type")


@query("op_K32_summary", sql("SELECT count(*) AS index_events, count(*) FILTER (WHERE i_click) AS clicks, count(*) FILTER (WHERE severity = 'severe') AS severe FROM st", _INDEX, _COMP, _STATUS))
def _(v):
    return phenotypes(v).agg(F.count("*").alias("index_events"), F.count_if("i_click").alias("clicks"), F.count_if(F.col("severity") == "severe").alias("severe"))


@query("op_K33_report_sections", sql("SELECT severity, count(*) AS n FROM st GROUP BY 1 ORDER BY 1", _INDEX, _COMP, _STATUS))
def _(v):
    return phenotypes(v).groupBy("severity").agg(F.count("*").alias("n")).orderBy("severity")


@query("op_K34_manifest_compare", """SELECT name, CASE WHEN r IS NULL THEN 'missing' WHEN l IS NULL THEN 'extra' WHEN l <> r THEN 'mismatched' ELSE 'same' END AS outcome, l AS left_rows, r AS right_rows FROM (
  SELECT 'customer' AS name, (SELECT count(*) FROM customer) AS l, (SELECT count(*) FROM customer) AS r UNION ALL SELECT 'nation', (SELECT count(*) FROM nation), (SELECT count(*) FROM nation WHERE n_regionkey <> 2)
  UNION ALL SELECT 'region', (SELECT count(*) FROM region), NULL UNION ALL SELECT 'part', NULL, (SELECT count(*) FROM part))""")
def _(v):
    from cairn.sources.manifests import compare_manifests

    customer, nation, region, part = tables(v.spark, v.dir, "customer", "nation", "region", "part")
    facts = lambda frames: {"tables": {n: aggregate.table_hash(df).first().asDict() for n, df in frames.items()}}
    left, right = facts({"customer": customer, "nation": nation, "region": region}), facts({"customer": customer, "nation": nation.filter("n_regionkey <> 2"), "part": part})
    found = compare_manifests(left, right)
    worse = {n for k in ("digest", "row_count", "columns") for n in found[k]}
    outcome = {n: k for k in ("missing", "extra") for n in found[k]}
    count = lambda side, n: side["tables"].get(n, {}).get("rows")
    rows = [(n, outcome.get(n, "mismatched" if n in worse else "same"), count(left, n), count(right, n)) for n in sorted(left["tables"].keys() | right["tables"].keys())]
    return v.spark.createDataFrame(rows, "name string, outcome string, left_rows long, right_rows long")


# ---- S, L: sinks and operations -----------------------------------------------------------------------------------


@query("op_S2_partitioned_write", sql("SELECT encounter_id, cost FROM enc WHERE type = 'EMER'"))
def _(v):
    from cairn.sources.writers import write_table

    path = write_table(v.enc.select("encounter_id", "cost", "type"), scratch(v, "part"), partition_by=["type"])
    return v.spark.read.parquet(path).filter("type = 'EMER'").select("encounter_id", "cost")


@query("op_S3_csv_round_trip", sql("SELECT event_id, code, CAST(value AS VARCHAR) AS value FROM ev"))
def _(v):
    from cairn.sources.readers import list_files, read_csv
    from cairn.sources.writers import write_table

    path = write_table(v.ev.select("event_id", "code", "value"), scratch(v, "csv"), fmt="csv")
    return read_csv(v.spark, list_files(v.spark, path), ["event_id", "code", "value"]).select(F.col("event_id").cast("bigint").alias("event_id"), "code", "value")


@query("op_S4_single_csv", sql("SELECT CAST(type AS VARCHAR) AS type, CAST(count(*) AS VARCHAR) AS n FROM enc GROUP BY 1"))
def _(v):
    from cairn.sources.readers import read_csv
    from cairn.sources.writers import write_one_csv

    counts = v.enc.groupBy("type").agg(F.count("*").alias("n"))
    return read_csv(v.spark, write_one_csv(v.spark, counts, scratch(v, "one") + ".csv", ["type"])).drop("_file")


@query("op_S6_split_csv", sql("SELECT count(*) AS rows, true AS split FROM ev"))
def _(v):
    from cairn.sources.readers import list_files, read_csv, row_counts
    from cairn.sources.writers import split_csv

    path = split_csv(v.ev.select("event_id", "code"), scratch(v, "split"), 300)
    return row_counts(read_csv(v.spark, list_files(v.spark, path))).agg(F.sum("rows").alias("rows"), (F.max("rows") <= 300).alias("split"))


@query("op_S7_views", "SELECT n_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def _(v):
    from cairn.sources.writers import register

    customer, nation = tables(v.spark, v.dir, "customer", "nation")
    register({"cairn_customer": customer, "cairn_nation": nation})
    return v.spark.sql("SELECT n_name, count(*) AS customers FROM cairn_customer JOIN cairn_nation ON c_nationkey = n_nationkey GROUP BY n_name")


@query("op_L12_dictionary", "SELECT 'nation' AS table_name, 1 AS ordinal, 'n_nationkey' AS column_name, 'int' AS data_type UNION ALL SELECT 'nation', 2, 'n_name', 'string' UNION ALL SELECT 'nation', 3, 'n_regionkey', 'int' UNION ALL SELECT 'region', 1, 'r_regionkey', 'int' UNION ALL SELECT 'region', 2, 'r_name', 'string'")
def _(v):
    from cairn.sources.manifests import data_dictionary

    nation, region = tables(v.spark, v.dir, "nation", "region")
    return data_dictionary(v.spark, {"nation": nation, "region": region}).drop("nullable")


# ---- I: streams -------------------------------------------------------------------------------------------------------


def _stream(v):
    from cairn.streaming.incremental import source

    (e,) = tables(v.spark, v.dir, "events")
    return source(v.spark, f"{v.dir}/events.parquet*", e.schema)


@query("op_I2_stream_keep_first", sql("SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events) WHERE r = 1"))
def _(v):
    from cairn.streaming.incremental import keep_first, run_to, source

    (e,) = tables(v.spark, v.dir, "events")
    some = e.select("user_id", "event_id", "ts")
    root = scratch(v, "stream")
    for turn in (1, 0):  # files arrive between two runs: the second one finds the first one's state
        some.filter(F.pmod(F.col("event_id"), F.lit(2)) == turn).write.mode("append").parquet(f"{root}/in")
        first = keep_first(source(v.spark, f"{root}/in", some.schema), "user_id", ["ts", "event_id"], ["user_id", "event_id", "ts"])
        run_to(first, f"{root}/out", f"{root}/checkpoint")
    # a key's latest update is its earliest row
    return v.spark.read.parquet(f"{root}/out").groupBy("user_id").agg(F.min_by("event_id", F.struct("ts", "event_id")).alias("event_id"))


@query("op_I4_stream_counts", sql(f"SELECT event_type, count(*) AS n_events, strftime(min(ts), {TS}) AS first_ts FROM events GROUP BY 1"))
def _(v):
    from cairn.streaming.incremental import counts, run_once

    return run_once(counts(_stream(v), ["event_type"], "ts"), f"cairn_{uuid.uuid4().hex}", mode="complete", checkpoint=scratch(v, "stream")).select("event_type", "n_events", sec("first_ts"))


@query("op_I3_stream_members", "SELECT DISTINCT user_id FROM events")
def _(v):
    from cairn.streaming.incremental import members, run_to

    root = scratch(v, "stream")
    run_to(members(_stream(v), ["user_id"]), f"{root}/out", f"{root}/checkpoint")
    return v.spark.read.parquet(f"{root}/out")
