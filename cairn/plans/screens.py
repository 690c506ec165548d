"""Screening of encounters and choice of a body mass index by the reference's rules, over roles of the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairn.functions import temporal
from cairn.operators import screening
from cairn.plans.registry import query
from cairn.plans.roles import sql, tables

# ---- roles: encounters with repeats, patients, gas results from order lines, vitals from order lines ---------------

_ROLES = """visit AS (SELECT subject_id AS patient_id, encounter_id, type AS encounter_type, start AS encounter_start, "end" AS encounter_end,
    CASE WHEN encounter_id % 2 = 0 THEN 'date_only' ELSE 'timestamp' END AS end_kind, CAST(encounter_id AS VARCHAR) AS record_id FROM enc
  UNION ALL SELECT subject_id, encounter_id, 'AMB', start + INTERVAL 1 DAY, "end", 'timestamp', 'again' FROM enc WHERE encounter_id % 50 = 0),
patient AS (SELECT subject_id AS patient_id, CASE WHEN subject_id % 31 <> 0 THEN birth_year END AS year_of_birth, region, CAST(subject_id AS VARCHAR) AS record_id FROM subj),
line AS (SELECT *, concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR), CAST(CAST(l_quantity AS BIGINT) AS VARCHAR), CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR)) AS record_id,
    o_orderdate + to_hours(CAST(l_suppkey % 40 - 4 AS INTEGER)) + to_minutes(CAST(l_partkey % 40 AS INTEGER)) AS full_ts, l_partkey % 5 = 0 AS dated FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
gas AS (SELECT o_custkey AS patient_id, l_orderkey AS encounter_id, record_id,
    ['arterial_pco2', 'arterial_pco2', 'venous_pco2', 'arterial_ph', 'arterial_ph', 'arterial_hco3', 'arterial_po2', 'arterial_sao2'][1 + (l_partkey + l_linenumber) % 8] AS concept,
    CASE WHEN (l_partkey + l_linenumber) % 8 IN (3, 4) THEN 7.2 + l_quantity / 125 ELSE 25 + l_quantity END AS value,
    CASE WHEN dated THEN date_trunc('day', full_ts) ELSE full_ts END AS ts, CASE WHEN dated THEN 'date_only' ELSE 'timestamp' END AS kind,
    CAST(l_quantity AS BIGINT) % 13 <> 0 AS usable, CAST(l_quantity AS BIGINT) % 17 <> 0 AS plausible,
    CASE WHEN l_partkey % 9 = 0 THEN ' Venous line' ELSE 'artery' END AS specimen, CASE WHEN l_suppkey % 4 = 0 THEN 's' || CAST(l_partkey % 3 AS VARCHAR) WHEN l_suppkey % 4 = 1 THEN '' END AS specimen_id, CAST(NULL AS VARCHAR) AS panel_id FROM line)"""


def _line(v):
    li, o = tables(v.spark, v.dir, "lineitem", "orders")
    rows = li.join(o.select("o_orderkey", "o_custkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    parts = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("long"), F.round(F.col("l_extendedprice") * 100).cast("long")]
    ts = F.col("o_orderdate") + F.make_dt_interval(hours=(F.col("l_suppkey") % 40 - 4).cast("int"), mins=(F.col("l_partkey") % 40).cast("int"))
    return rows.withColumn("record_id", F.concat_ws("|", *[F.col(p) if isinstance(p, str) else p for p in parts])).withColumn("full_ts", ts).withColumn("dated", F.col("l_partkey") % 5 == 0)


def _visits(v):
    e = F.col("encounter_id")
    kind = F.when(e % 2 == 0, temporal.DATE_ONLY).otherwise(temporal.TIMESTAMP)
    once = v.enc.select(F.col("subject_id").alias("patient_id"), e, F.col("type").alias("encounter_type"), F.col("start").alias("encounter_start"), F.col("end").alias("encounter_end"), kind.alias("end_kind"), e.cast("string").alias("record_id"))
    again = once.filter(e % 50 == 0).withColumns({"encounter_type": F.lit("AMB"), "encounter_start": temporal.days_from(F.col("encounter_start"), 1), "end_kind": F.lit(temporal.TIMESTAMP), "record_id": F.lit("again")})
    return once.unionByName(again)


def _patients(v):
    s = F.col("subject_id")
    return v.subj.select(s.alias("patient_id"), F.when(s % 31 != 0, F.col("birth_year")).alias("year_of_birth"), "region", s.cast("string").alias("record_id"))


def _gas(v):
    number = (F.col("l_partkey") + F.col("l_linenumber")) % 8
    names = ["arterial_pco2", "arterial_pco2", "venous_pco2", "arterial_ph", "arterial_ph", "arterial_hco3", "arterial_po2", "arterial_sao2"]
    q, ts = F.col("l_quantity"), F.col("full_ts")
    return _line(v).select(
        F.col("o_custkey").alias("patient_id"), F.col("l_orderkey").alias("encounter_id"), "record_id", F.element_at(F.array(*map(F.lit, names)), (number + 1).cast("int")).alias("concept"),
        F.when(number.isin(3, 4), 7.2 + q / 125).otherwise(25 + q).alias("value"),
        F.when(F.col("dated"), temporal.day(ts)).otherwise(ts).alias("ts"), F.when(F.col("dated"), temporal.DATE_ONLY).otherwise(temporal.TIMESTAMP).alias("kind"),
        (q.cast("long") % 13 != 0).alias("usable"), (q.cast("long") % 17 != 0).alias("plausible"),
        F.when(F.col("l_partkey") % 9 == 0, " Venous line").otherwise("artery").alias("specimen"),
        F.when(F.col("l_suppkey") % 4 == 0, F.concat(F.lit("s"), (F.col("l_partkey") % 3).cast("string"))).when(F.col("l_suppkey") % 4 == 1, "").alias("specimen_id"), F.lit(None).cast("string").alias("panel_id"),
    )


# ---- K16 --------------------------------------------------------------------------------------------------------

_SCREEN = """v1 AS (SELECT * FROM visit QUALIFY row_number() OVER (PARTITION BY patient_id, encounter_id ORDER BY encounter_start, record_id) = 1),
w AS (SELECT g.*, encounter_start FROM gas g JOIN v1 USING (patient_id, encounter_id) WHERE ts BETWEEN encounter_start AND encounter_start + INTERVAL 24 HOUR OR (kind = 'date_only' AND CAST(ts AS DATE) BETWEEN CAST(encounter_start AS DATE) AND CAST(encounter_start + INTERVAL 24 HOUR AS DATE))),
art AS (SELECT * FROM w WHERE concept = 'arterial_pco2' QUALIFY row_number() OVER (PARTITION BY patient_id, encounter_id ORDER BY ts, record_id) = 1),
ven AS (SELECT * FROM w WHERE concept = 'venous_pco2' QUALIFY row_number() OVER (PARTITION BY patient_id, encounter_id ORDER BY ts, record_id) = 1),
fin AS (SELECT patient_id, encounter_id, encounter_start, CASE WHEN encounter_end IS NULL THEN encounter_start + INTERVAL 1 DAY WHEN end_kind = 'date_only' THEN date_trunc('day', encounter_end) + INTERVAL 1 DAY - INTERVAL 1 MICROSECOND ELSE encounter_end END AS until FROM v1),
top AS (SELECT patient_id, encounter_id, max(value) AS maximum FROM gas JOIN fin USING (patient_id, encounter_id) WHERE concept = 'arterial_pco2' AND usable AND plausible AND (ts BETWEEN encounter_start AND until OR (kind = 'date_only' AND CAST(ts AS DATE) BETWEEN CAST(encounter_start AS DATE) AND CAST(until AS DATE))) GROUP BY 1, 2),
pr AS (SELECT a.patient_id, a.encounter_id, c.concept, c.value, c.record_id, CASE WHEN a.kind = 'date_only' OR c.kind = 'date_only' THEN NULL ELSE abs(date_diff('minute', a.ts, c.ts)) END AS minutes,
    CASE WHEN a.specimen_id <> '' AND a.specimen_id = c.specimen_id THEN 1 WHEN a.kind = 'timestamp' AND c.kind = 'timestamp' AND a.ts = c.ts THEN 2 WHEN a.kind = 'timestamp' AND c.kind = 'timestamp' AND abs(date_diff('minute', a.ts, c.ts)) <= 30 THEN 3 WHEN (a.kind = 'date_only' OR c.kind = 'date_only') AND CAST(a.ts AS DATE) = CAST(c.ts AS DATE) THEN 4 END AS level
  FROM art a JOIN gas c USING (patient_id, encounter_id) WHERE c.concept IN ('arterial_ph', 'arterial_hco3', 'arterial_po2', 'arterial_sao2') AND c.usable AND c.plausible),
best AS (SELECT * FROM pr WHERE level IS NOT NULL QUALIFY row_number() OVER (PARTITION BY patient_id, encounter_id, concept ORDER BY level, minutes NULLS LAST, record_id) = 1),
cand AS (SELECT v1.patient_id, v1.encounter_id, v1.encounter_type, v1.encounter_start, v1.encounter_end, v1.end_kind, p.region, p.year_of_birth, year(v1.encounter_start) - p.year_of_birth AS age_at_index, a.value AS abg, a.usable AS au, a.plausible AS ap, a.record_id AS ah, a.specimen AS asp,
    ph.value AS ph, ph.level AS level, ph.minutes AS minutes, h.value AS abg_hco3, o.value AS abg_po2, s.value AS abg_sao2, top.maximum, coalesce(ven.usable AND ven.plausible AND ven.value > 45, false) AS vhigh
  FROM v1 LEFT JOIN patient p USING (patient_id) LEFT JOIN art a USING (patient_id, encounter_id) LEFT JOIN ven USING (patient_id, encounter_id) LEFT JOIN top USING (patient_id, encounter_id)
    LEFT JOIN best ph ON ph.patient_id = v1.patient_id AND ph.encounter_id = v1.encounter_id AND ph.concept = 'arterial_ph' LEFT JOIN best h ON h.patient_id = v1.patient_id AND h.encounter_id = v1.encounter_id AND h.concept = 'arterial_hco3'
    LEFT JOIN best o ON o.patient_id = v1.patient_id AND o.encounter_id = v1.encounter_id AND o.concept = 'arterial_po2' LEFT JOIN best s ON s.patient_id = v1.patient_id AND s.encounter_id = v1.encounter_id AND s.concept = 'arterial_sao2'
  WHERE a.record_id IS NOT NULL OR vhigh),
judged AS (SELECT *, sha256(concat_ws(chr(31), 'index-v1', CAST(patient_id AS VARCHAR), CAST(encounter_id AS VARCHAR), strftime(encounter_start, '%Y-%m-%d %H:%M:%S'))) AS index_event_id,
    CASE WHEN year_of_birth IS NULL THEN 'missing_age' WHEN age_at_index < 18 THEN 'age_under_minimum' WHEN upper(trim(encounter_type)) NOT IN ('EMER', 'IMP') THEN 'encounter_type_out_of_scope' WHEN ah IS NULL THEN 'no_arterial_pco2'
      WHEN NOT au THEN 'first_arterial_pco2_unit_unusable' WHEN NOT ap THEN 'first_arterial_pco2_implausible' WHEN abg <= 45 THEN 'first_arterial_pco2_not_elevated' WHEN ph IS NULL THEN 'missing_paired_ph' WHEN ph > 7.45 THEN 'paired_ph_above_maximum' END AS reason FROM cand)"""

_FLAGS = ("elevated", "elevated_ge50", "elevated_ge52", "acute", "compensated", "without_companion", "elevated_later", "other_source_only", "probably_other_specimen", "unusable_or_implausible", "eligible")


def _cohort(v):
    return screening.candidates(_visits(v), _patients(v), _gas(v))


@query("op_K16_screened_cohort", sql("""SELECT index_event_id, patient_id, encounter_id, age_at_index, region, abg AS abg_pco2, round(ph, 6) AS abg_ph, abg_hco3, abg_po2, abg_sao2,
    ['same_specimen_or_panel', 'exact_timestamp', 'nearest_within_tolerance', 'same_date_date_only'][level] AS pairing_method, ['highest', 'high', 'moderate', 'date_only'][level] AS pairing_quality, minutes AS pairing_minutes, maximum AS maximum_in_encounter,
    coalesce(au AND ap AND abg > 45, false) AS elevated, coalesce(au AND ap AND abg >= 50, false) AS elevated_ge50, coalesce(au AND ap AND abg >= 52, false) AS elevated_ge52, coalesce(ph < 7.35, false) AS acute, coalesce(abg > 45 AND ph BETWEEN 7.35 AND 7.45, false) AS compensated,
    coalesce(au AND ap AND abg > 45 AND ph IS NULL, false) AS without_companion, coalesce(au AND ap AND abg <= 45 AND maximum > 45, false) AS elevated_later, ah IS NULL AND vhigh AS other_source_only, regexp_matches(lower(trim(coalesce(asp, ''))), 'venous|vein|vbg') AS probably_other_specimen,
    ah IS NOT NULL AND NOT (au AND ap) AS unusable_or_implausible, coalesce(year_of_birth IS NOT NULL AND age_at_index >= 18 AND upper(trim(encounter_type)) IN ('EMER', 'IMP'), false) AS eligible,
    CASE WHEN reason IS NULL THEN 'included' ELSE 'excluded' END AS status, reason, reason IS NULL AND row_number() OVER (PARTITION BY patient_id, reason IS NULL ORDER BY encounter_start, index_event_id) = 1 AS is_first FROM judged""", _ROLES, _SCREEN))
def _(v):
    out = _cohort(v).withColumn("abg_ph", F.round("abg_ph", 6))
    return out.select("index_event_id", "patient_id", "encounter_id", "age_at_index", "region", "abg_pco2", "abg_ph", "abg_hco3", "abg_po2", "abg_sao2", "pairing_method", "pairing_quality", "pairing_minutes", "maximum_in_encounter", *_FLAGS, "status", "reason", "is_first")


@query("op_K16_reasons", sql("SELECT coalesce(reason, 'included') AS reason, count(*) AS n FROM judged GROUP BY 1", _ROLES, _SCREEN))
def _(v):
    return _cohort(v).groupBy(F.coalesce("reason", F.lit("included")).alias("reason")).agg(F.count("*").alias("n"))


# ---- K18 --------------------------------------------------------------------------------------------------------

_VITALS = """vital AS (SELECT o_custkey AS patient_id, CASE WHEN l_partkey % 6 <> 0 THEN l_orderkey END AS encounter_id, record_id, ['bmi', 'weight', 'height', 'weight', 'height'][1 + (l_suppkey + l_linenumber) % 5] AS concept,
    CASE WHEN l_partkey % 19 = 0 THEN 'n/a' ELSE CAST(CAST(CASE (l_suppkey + l_linenumber) % 5 WHEN 0 THEN 8 + l_quantity WHEN 1 THEN 40 + 2 * l_quantity WHEN 3 THEN 40 + 2 * l_quantity ELSE 140 + l_quantity END AS BIGINT) AS VARCHAR) END AS value,
    CASE (l_suppkey + l_linenumber) % 5 WHEN 0 THEN ['kg/m2', 'KG/M^2 ', 'stone'][1 + l_partkey % 3] WHEN 1 THEN 'kg' WHEN 3 THEN ' Lbs' WHEN 2 THEN 'cm' ELSE 'CM' END AS unit,
    CASE WHEN dated THEN date_trunc('day', full_ts) ELSE full_ts END AS ts, CASE WHEN dated THEN 'date_only' ELSE 'timestamp' END AS kind FROM line),
norm AS (SELECT *, CASE concept WHEN 'bmi' THEN CASE WHEN lower(trim(unit)) IN ('kg/m2', 'kg/m^2') THEN x END WHEN 'weight' THEN CASE lower(trim(unit)) WHEN 'kg' THEN x WHEN 'lbs' THEN x * 0.45359237 END ELSE CASE lower(trim(unit)) WHEN 'cm' THEN x / 100.0 END END AS nv FROM (SELECT *, TRY_CAST(value AS DOUBLE) AS x FROM vital)),
fit AS (SELECT * FROM norm WHERE CASE concept WHEN 'bmi' THEN nv BETWEEN 10 AND 100 WHEN 'weight' THEN nv BETWEEN 20 AND 500 ELSE nv BETWEEN 1.0 AND 2.5 END),
calc AS (SELECT w.patient_id, greatest(w.ts, h.ts) AS ts, CASE WHEN w.ts > h.ts THEN w.kind WHEN h.ts > w.ts THEN h.kind WHEN w.kind = 'date_only' OR h.kind = 'date_only' THEN 'date_only' ELSE 'timestamp' END AS kind, w.nv / power(h.nv, 2) AS bmi, w.nv AS weight_kg, h.nv AS height_m, w.record_id || ':' || h.record_id AS record_id
  FROM fit w JOIN fit h ON h.patient_id = w.patient_id AND coalesce(h.encounter_id, -1) = coalesce(w.encounter_id, -1) AND abs(date_diff('hour', w.ts, h.ts)) <= 24 WHERE w.concept = 'weight' AND h.concept = 'height' AND w.nv / power(h.nv, 2) BETWEEN 10 AND 100
  QUALIFY row_number() OVER (PARTITION BY w.record_id ORDER BY abs(date_diff('second', w.ts, h.ts)), h.record_id) = 1),
ix AS (SELECT index_event_id, patient_id, encounter_id, encounter_start AS index_ts, encounter_end, end_kind FROM judged WHERE reason IS NULL OR reason = 'encounter_type_out_of_scope'),
bc AS (SELECT index_event_id, index_ts, ts, bmi, weight_kg, height_m, record_id, rk FROM ix JOIN (SELECT patient_id, ts, kind, nv AS bmi, CAST(NULL AS DOUBLE) AS weight_kg, CAST(NULL AS DOUBLE) AS height_m, record_id, 1 AS rk FROM fit WHERE concept = 'bmi' UNION ALL SELECT patient_id, ts, kind, bmi, weight_kg, height_m, record_id, 2 FROM calc) USING (patient_id)
    WHERE ts <= index_ts AND CASE kind WHEN 'date_only' THEN CAST(ts AS DATE) >= CAST(index_ts AS DATE) - 365 ELSE ts >= index_ts - INTERVAL 365 DAY END
  UNION ALL SELECT index_event_id, index_ts, ts, nv, NULL, NULL, record_id, 3 FROM ix JOIN fit USING (patient_id, encounter_id) WHERE concept = 'bmi' AND ts > index_ts
    AND ts <= CASE WHEN encounter_end IS NULL THEN index_ts + INTERVAL 1 DAY WHEN end_kind = 'date_only' THEN date_trunc('day', encounter_end) + INTERVAL 1 DAY - INTERVAL 1 MICROSECOND ELSE encounter_end END),
bb AS (SELECT * FROM bc QUALIFY row_number() OVER (PARTITION BY index_event_id ORDER BY rk, abs(date_diff('second', ts, index_ts)), record_id) = 1)"""


def _vitals(v):
    number, q = (F.col("l_suppkey") + F.col("l_linenumber")) % 5, F.col("l_quantity").cast("long")
    value = F.when(number == 0, 8 + q).when(number.isin(1, 3), 40 + 2 * q).otherwise(140 + q)
    unit = F.when(number == 0, F.element_at(F.array(F.lit("kg/m2"), F.lit("KG/M^2 "), F.lit("stone")), (F.col("l_partkey") % 3 + 1).cast("int"))).when(number == 1, "kg").when(number == 3, " Lbs").when(number == 2, "cm").otherwise("CM")
    return _line(v).select(
        F.col("o_custkey").alias("patient_id"), F.when(F.col("l_partkey") % 6 != 0, F.col("l_orderkey")).alias("encounter_id"), "record_id",
        F.element_at(F.array(*map(F.lit, ("bmi", "weight", "height", "weight", "height"))), (number + 1).cast("int")).alias("concept"),
        F.when(F.col("l_partkey") % 19 == 0, "n/a").otherwise(value.cast("string")).alias("value"), unit.alias("unit"),
        F.when(F.col("dated"), temporal.day(F.col("full_ts"))).otherwise(F.col("full_ts")).alias("ts"), F.when(F.col("dated"), temporal.DATE_ONLY).otherwise(temporal.TIMESTAMP).alias("kind"),
    )


@query("op_K18_bmi_selection", sql("""SELECT ix.index_event_id, round(bmi, 6) AS bmi, ['measured_pre_index', 'calculated_height_weight', 'measured_index_encounter'][rk] AS bmi_source, record_id AS bmi_record_id, round(weight_kg, 6) AS weight_kg, height_m, date_diff('day', ix.index_ts, ts) AS bmi_days_from_index,
    bmi >= 30 AS bmi_ge30, bmi >= 40 AS bmi_ge40, CASE WHEN bmi >= 40 THEN 'class_III' WHEN bmi >= 35 THEN 'class_II' WHEN bmi >= 30 THEN 'class_I' WHEN bmi IS NOT NULL THEN 'not_obese' END AS obesity_class, CASE WHEN bmi IS NULL THEN 'indeterminate' WHEN bmi >= 30 THEN 'met' ELSE 'not_met' END AS obesity_status FROM ix LEFT JOIN bb USING (index_event_id)""", _ROLES, _SCREEN, _VITALS))
def _(v):
    index = _cohort(v).filter("reason IS NULL OR reason = 'encounter_type_out_of_scope'").select("index_event_id", "patient_id", "encounter_id", F.col("encounter_start").alias("index_ts"), "encounter_end", "end_kind")
    out = screening.choose_bmi(index, _vitals(v))
    return out.select("index_event_id", F.round("bmi", 6).alias("bmi"), "bmi_source", "bmi_record_id", F.round("weight_kg", 6).alias("weight_kg"), "height_m", F.col("bmi_days_from_index").cast("long").alias("bmi_days_from_index"), "bmi_ge30", "bmi_ge40", "obesity_class", "obesity_status")
