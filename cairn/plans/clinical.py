"""The clinical product as queries: statuses (K21), indications and routes (K22), first vitals (K7) and event categories (K1).

The driver's tables hold no diagnoses, so each subject's features are made from
its number by one rule, the same in SQL.  The SQL forms of the statuses are
written by hand from the definitions, not from the engine's tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cairn.operators import clinical, cohort
from cairn.plans.registry import query
from cairn.plans.roles import sql

FLAGS = (
    "dx_t2d dx_prediabetes dx_prior_mi dx_ischemic_stroke dx_pad dx_symptomatic_pad proc_lower_revascularization egfr_persistent_lt60 dx_ckd_any dx_eskd dx_ckd_stage_3a_plus dx_osa dx_mash dx_cirrhosis "
    "dx_heart_failure dx_hfpef dx_hypertension dx_ohs dx_pcos dx_knee_oa dx_aud dx_iih dx_binge_eating dx_masld dx_dyslipidemia dx_metabolic_syndrome dx_copd dx_asthma dx_neuromuscular dx_chest_wall "
    "proc_liver_biopsy proc_elastography compensated_hypercapnia persistent_hypercapnia_14_84d proc_polysomnography proc_hsat antipsychotic_active"
).split()
#: Lowest value, step (97 of them) and how often it is missing.
NUMBERS = {
    "diabetes_range_a1c_dates": (0, 0.04, 3), "a1c_latest": (5.0, 0.02, 4), "ahi_rei_value": (0, 0.5, 3), "lvef": (30, 0.4, 3), "latest_sbp": (110, 0.6, 4), "latest_dbp": (70, 0.4, 3),
    "active_antihypertensive_ingredient_count": (0, 0.04, 7), "age_at_index": (30, 0.5, 11), "ast_latest": (10, 0.7, 6), "alt_latest": (8, 0.6, 5), "platelets_latest": (100, 3.0, 7), "bmi": (24, 0.15, 6),
}


def _expressions(mod: str) -> list[tuple[str, str]]:
    """(column, SQL over subject_id); ``mod`` writes a remainder."""
    rem = lambda a, n: mod.format(a=a, n=n)
    out = [(f, f"{rem(f'subject_id * {2 * j + 3} + {j * j}', 7 + j % 4)} = 0") for j, f in enumerate(FLAGS)]
    for j, (name, (low, step, gap)) in enumerate(NUMBERS.items()):
        out.append((name, f"CASE WHEN {rem(f'subject_id + {j}', gap)} <> 0 THEN CAST({low} AS DOUBLE) + CAST({step} AS DOUBLE) * {rem(f'subject_id * {5 * j + 7}', 97)} END"))
    out.append(("fibrosis_stage", f"CASE {rem('subject_id * 11', 7)} WHEN 0 THEN 'F0' WHEN 1 THEN 'F1' WHEN 2 THEN 'F2' WHEN 3 THEN 'F3' WHEN 4 THEN 'F4' END"))
    return out


def features(v):
    """A row of features for each subject."""
    made = v.subj.select("subject_id", *[F.expr(e).alias(n) for n, e in _expressions("({a}) % {n}")])
    bmi = F.col("bmi")
    return made.withColumns({"bmi_valid": bmi.isNotNull(), **{f"bmi_ge{n}": bmi >= n for n in (27, 30, 35)}})


_FEATURES = "f0 AS (SELECT subject_id, " + ", ".join(f"{e} AS {n}" for n, e in _expressions("({a}) % {n}")) + " FROM subj), f AS (SELECT *, bmi IS NOT NULL AS bmi_valid, bmi >= 27 AS bmi_ge27, bmi >= 30 AS bmi_ge30, bmi >= 35 AS bmi_ge35 FROM f0)"


def _met(*flags: str) -> str:
    return f"CASE WHEN {' OR '.join(flags)} THEN 'met' ELSE 'indeterminate' END"


_STATUSES = f"""s AS (SELECT *,
  CASE WHEN dx_t2d THEN 'met' WHEN diabetes_range_a1c_dates >= 2 THEN 'met' ELSE 'indeterminate' END AS t2d_status,
  CASE WHEN dx_t2d THEN 'strict' WHEN diabetes_range_a1c_dates >= 2 THEN 'probable' ELSE 'not_applicable' END AS t2d_certainty,
  CASE WHEN dx_t2d THEN 'not_met' WHEN diabetes_range_a1c_dates >= 2 THEN 'not_met' WHEN dx_prediabetes THEN 'met' WHEN a1c_latest >= 5.7 AND a1c_latest <= 6.4 THEN 'met' WHEN a1c_latest < 5.7 THEN 'not_met' ELSE 'indeterminate' END AS prediabetes_status,
  {_met('dx_prior_mi')} AS prior_mi_status, {_met('dx_ischemic_stroke')} AS prior_ischemic_stroke_status, {_met('dx_pad')} AS pad_status,
  {_met('dx_symptomatic_pad', 'proc_lower_revascularization')} AS symptomatic_pad_status,
  {_met('dx_prior_mi', 'dx_ischemic_stroke', 'dx_pad', 'proc_lower_revascularization')} AS established_cvd_any_status,
  {_met('dx_ckd_any', 'dx_eskd', 'egfr_persistent_lt60')} AS ckd_any_status, {_met('dx_ckd_stage_3a_plus', 'dx_eskd', 'egfr_persistent_lt60')} AS ckd_stage_3a_plus_status,
  CASE WHEN dx_eskd THEN 'ESKD' WHEN dx_ckd_stage_3a_plus THEN '3a_plus' END AS ckd_stage,
  {_met('dx_osa')} AS osa_any_status,
  CASE WHEN ahi_rei_value IS NULL THEN 'indeterminate' WHEN ahi_rei_value < 15 THEN 'not_met' ELSE 'met' END AS osa_moderate_severe_status,
  CASE WHEN ahi_rei_value IS NULL THEN 'indeterminate' WHEN ahi_rei_value < 5 THEN 'none' WHEN ahi_rei_value < 15 THEN 'mild' WHEN ahi_rei_value < 30 THEN 'moderate' ELSE 'severe' END AS osa_severity,
  {_met('dx_mash')} AS mash_status, {_met('dx_cirrhosis')} AS cirrhosis_status,
  CASE WHEN NOT dx_mash THEN 'indeterminate' WHEN dx_cirrhosis THEN 'not_met' WHEN fibrosis_stage IS NULL THEN 'indeterminate' WHEN fibrosis_stage IN ('F2', 'F3') THEN 'met' ELSE 'not_met' END AS mash_f2_f3_status,
  CASE WHEN dx_mash AND fibrosis_stage IS NOT NULL THEN 'strict' ELSE 'not_applicable' END AS mash_f2_f3_certainty,
  CASE WHEN fibrosis_stage IS NULL THEN CASE WHEN proc_liver_biopsy THEN 'biopsy_without_stage' WHEN proc_elastography THEN 'elastography_without_stage' END
       WHEN proc_liver_biopsy THEN 'biopsy' WHEN proc_elastography THEN 'elastography' ELSE 'structured_stage_result' END AS fibrosis_method,
  CASE WHEN platelets_latest > 0 AND alt_latest > 0 THEN round(age_at_index * ast_latest / (platelets_latest * sqrt(alt_latest)), 9) END AS fib4_latest,
  {_met('dx_heart_failure')} AS heart_failure_status,
  CASE WHEN lvef < 50 THEN 'not_met' WHEN lvef >= 50 AND dx_heart_failure THEN 'met' WHEN dx_hfpef THEN 'met' ELSE 'indeterminate' END AS hfpef_status,
  CASE WHEN lvef >= 50 AND dx_heart_failure THEN 'strict' WHEN dx_hfpef THEN 'code_only' ELSE 'not_applicable' END AS hfpef_certainty,
  {_met('dx_hypertension')} AS hypertension_status,
  CASE WHEN latest_sbp IS NULL AND latest_dbp IS NULL THEN 'indeterminate' WHEN active_antihypertensive_ingredient_count >= 2 AND (coalesce(latest_sbp, 0) > 140 OR coalesce(latest_dbp, 0) > 90) THEN 'met' ELSE 'not_met' END AS uncontrolled_hypertension_two_meds_status,
  {_met('dx_ohs')} AS ohs_documented_status,
  CASE WHEN bmi >= 30 AND (compensated_hypercapnia OR persistent_hypercapnia_14_84d) AND (dx_osa OR proc_polysomnography OR proc_hsat) AND NOT (dx_neuromuscular OR dx_chest_wall) THEN 'met' ELSE 'indeterminate' END AS probable_ohs_status,
  {_met('dx_pcos')} AS pcos_status, {_met('dx_knee_oa')} AS knee_oa_status, {_met('dx_aud')} AS aud_status, {_met('dx_iih')} AS iih_status, {_met('dx_binge_eating')} AS binge_eating_status,
  CASE WHEN NOT antipsychotic_active THEN 'indeterminate' WHEN bmi >= 27 OR a1c_latest >= 5.7 OR dx_metabolic_syndrome THEN 'met' ELSE 'not_met' END AS metabolic_dysfunction_status,
  {_met('dx_masld')} AS masld_status, {_met('dx_dyslipidemia')} AS dyslipidemia_status, {_met('dx_metabolic_syndrome')} AS metabolic_syndrome_status, {_met('dx_copd')} AS copd_status, {_met('dx_asthma')} AS asthma_status,
  {_met('dx_neuromuscular')} AS neuromuscular_disease_status, {_met('dx_chest_wall')} AS chest_wall_disease_status
  FROM f)"""
STATUS_NAMES = sorted([*clinical.ANY_OF, *clinical.LADDERS, "fib4_latest"])


@query("op_K21_clinical", sql(f"SELECT subject_id, {', '.join(STATUS_NAMES)} FROM s", _FEATURES, _STATUSES))
def _(v):
    out = clinical.with_statuses(features(v))
    return out.withColumn("fib4_latest", F.round("fib4_latest", 9)).select("subject_id", *STATUS_NAMES)


_TIERS = """t AS (SELECT *,
  CASE WHEN bmi >= 30 OR (bmi >= 27 AND 'met' IN (t2d_status, prediabetes_status, hypertension_status, dyslipidemia_status, osa_any_status, established_cvd_any_status)) THEN true WHEN bmi IS NOT NULL THEN false END AS ind_fda_weight_management,
  CASE WHEN t2d_status = 'met' THEN true END AS a1, CASE WHEN bmi >= 27 AND established_cvd_any_status = 'met' THEN true END AS a2, CASE WHEN t2d_status = 'met' AND ckd_any_status = 'met' THEN true END AS a3,
  CASE WHEN bmi >= 30 AND osa_moderate_severe_status = 'met' THEN true END AS a4, CASE WHEN bmi >= 27 AND mash_f2_f3_status = 'met' AND cirrhosis_status <> 'met' THEN true END AS a5,
  CASE WHEN bmi >= 30 AND probable_ohs_status = 'met' THEN true END AS b1, CASE WHEN bmi >= 30 AND hfpef_status = 'met' AND hfpef_certainty = 'strict' THEN true END AS b2, CASE WHEN bmi >= 27 AND pcos_status = 'met' THEN true END AS b3,
  CASE WHEN t2d_status = 'met' AND symptomatic_pad_status = 'met' THEN true END AS c2, CASE WHEN bmi >= 30 AND knee_oa_status = 'met' THEN true END AS c3, CASE WHEN aud_status = 'met' THEN true END AS c4,
  CASE WHEN bmi >= 27 AND iih_status = 'met' THEN true END AS c5, CASE WHEN metabolic_dysfunction_status = 'met' THEN true END AS c6,
  hfpef_status = 'met' AND hfpef_certainty = 'strict' AS hf FROM s),
u AS (SELECT *, coalesce(a1, a2, a3, a4, a5) AS fda,
  CASE WHEN bmi >= 35 THEN 'bmi_ge35' WHEN bmi >= 30 AND (hf OR uncontrolled_hypertension_two_meds_status = 'met' OR ckd_stage_3a_plus_status = 'met') THEN 'bmi_ge30_comorbidity'
       WHEN bmi >= 27 AND 'met' IN (prediabetes_status, prior_mi_status, prior_ischemic_stroke_status, symptomatic_pad_status) THEN 'bmi_ge27_comorbidity' END AS branch FROM t),
w AS (SELECT *, CASE WHEN branch IS NOT NULL THEN 'met' WHEN bmi < 27 THEN 'not_met' ELSE 'indeterminate' END AS bridge FROM u)"""
_LIST = "list_aggregate(list_filter([{0}], lambda x: x IS NOT NULL), 'string_agg', ';')"


def _listed(**named: str) -> str:
    return "coalesce(" + _LIST.format(", ".join(f"CASE WHEN {flag} THEN '{label}' END" for label, flag in named.items())) + ", '')"


@query(
    "op_K22_clinical",
    sql(
        f"""SELECT subject_id, ind_fda_weight_management, CASE WHEN bmi IS NOT NULL THEN 'strict' ELSE 'not_applicable' END AS ind_fda_weight_management_certainty,
  fda AS ind_fda_disease_specific_any, coalesce(b1, b2, b3) AS ind_guideline_any, coalesce(b2, c2, c3, c4, c5, c6, b3) AS ind_rct_any,
  CAST(len(list_filter([a1, a2, a3, a4, a5], lambda x: x)) AS INTEGER) AS num_fda_indication_groups, CAST(len(list_filter([b1, b2, b3], lambda x: x)) AS INTEGER) AS num_guideline_indication_groups, CAST(len(list_filter([b2, c2, c3, c4, c5, c6, b3], lambda x: x)) AS INTEGER) AS num_rct_indication_groups,
  {_listed(t2d='a1', obesity_established_cvd='a2', t2d_ckd='a3', moderate_severe_osa='a4', mash_f2_f3='a5')} AS fda_indication_group_list,
  {_listed(probable_ohs='b1', obesity_hfpef='b2', pcos_obesity='b3')} AS guideline_indication_group_list,
  {_listed(obesity_hfpef='b2', symptomatic_pad_t2d='c2', knee_oa_obesity='c3', alcohol_use_disorder='c4', iih='c5', antipsychotic_metabolic='c6', pcos_obesity='b3')} AS rct_indication_group_list,
  branch AS bridge_qualifying_branch, bridge AS bridge_clinical_criteria_status, CASE WHEN bridge = 'indeterminate' THEN 'not_applicable' ELSE 'strict' END AS bridge_certainty,
  {_listed(hfpef='hf', uncontrolled_hypertension_two_meds="uncontrolled_hypertension_two_meds_status = 'met'", ckd_3a_plus="ckd_stage_3a_plus_status = 'met'", prediabetes="prediabetes_status = 'met'", prior_mi="prior_mi_status = 'met'", prior_stroke="prior_ischemic_stroke_status = 'met'", symptomatic_pad="symptomatic_pad_status = 'met'")} AS bridge_qualifying_components,
  CASE WHEN fda THEN 'met' WHEN bridge = 'met' THEN 'not_met' ELSE 'indeterminate' END AS bridge_partd_exclusion_status, CASE WHEN fda THEN 'met' ELSE 'indeterminate' END AS part_d_disease_route_status,
  CASE WHEN fda THEN 'part_d_disease_route' WHEN bridge = 'met' THEN 'bridge_clinical_route' WHEN ind_fda_weight_management THEN 'weight_label_only' WHEN bridge = 'indeterminate' THEN 'potential_bridge_but_indeterminate' ELSE 'no_documented_route' END AS payer_route_model FROM w""",
        _FEATURES, _STATUSES, _TIERS,
    ),
)
def _(v):
    out = clinical.with_indications(clinical.with_statuses(features(v)))
    tiers = [c for t in ("fda", "guideline", "rct") for c in ("ind_fda_disease_specific_any" if t == "fda" else f"ind_{t}_any", f"num_{t}_indication_groups", f"{t}_indication_group_list")]
    return out.select("subject_id", "ind_fda_weight_management", "ind_fda_weight_management_certainty", *tiers, "bridge_qualifying_branch", "bridge_clinical_criteria_status", "bridge_certainty", "bridge_qualifying_components", "bridge_partd_exclusion_status", "part_d_disease_route_status", "payer_route_model")


_LEDGER_STATUSES = [c for c in STATUS_NAMES if c.endswith("_status")]
_LEDGER_TIERS = {"ind_fda_weight_management": "fda", "ind_fda_disease_specific_any": "fda", "ind_guideline_any": "guideline", "ind_rct_any": "rct"}
_LEDGER_SOURCES = ("view", "click", "purchase", "error", "signup")


def _sure(column: str) -> str:
    own = column.removesuffix("_status") + "_certainty"
    return own if own in STATUS_NAMES else f"CASE WHEN {column} IN ('met', 'not_met') THEN 'strict' ELSE 'not_applicable' END"


_LEDGER_SQL = " UNION ALL ".join(
    [f"SELECT subject_id, 'source:{c}' AS evidence_id, 'component' AS tier, 'source_record' AS evidence_type, 'met' AS status, 'strict' AS certainty, CAST(event_id AS VARCHAR) AS record_id, CAST(row_number() OVER (PARTITION BY subject_id ORDER BY ts DESC, CAST(event_id AS VARCHAR)) AS INTEGER) AS evidence_rank FROM ev WHERE code = '{c}'" for c in _LEDGER_SOURCES]
    + [f"SELECT subject_id, 'status:{c}', 'component', 'derived_status', {c}, {_sure(c)}, NULL, 1 FROM w" for c in _LEDGER_STATUSES]
    + [f"SELECT subject_id, '{c}', '{tier}', 'derived_rule', CASE WHEN {flag} THEN 'met' ELSE 'not_met' END, 'strict', NULL, 1 FROM w WHERE ({flag}) IS NOT NULL" for (c, tier), flag in zip(_LEDGER_TIERS.items(), ("ind_fda_weight_management", "fda", "coalesce(b1, b2, b3)", "coalesce(b2, c2, c3, c4, c5, c6, b3)"))]
)


@query("op_K23_ledger", sql(_LEDGER_SQL, _FEATURES, _STATUSES, _TIERS))
def _(v):
    derived = clinical.with_indications(clinical.with_statuses(features(v)))
    sources = {c: v.ev.filter(F.col("code") == c).select("subject_id", "ts", F.col("event_id").alias("record_id")) for c in _LEDGER_SOURCES}
    return cohort.ledger(sources, derived, key="subject_id", statuses=_LEDGER_STATUSES, indications=_LEDGER_TIERS).drop("ts")


_CODES = "CASE event_id % 8 WHEN 0 THEN 'J96.01' WHEN 1 THEN 'E66.2' WHEN 2 THEN 'e66.01' WHEN 3 THEN '94660' WHEN 4 THEN 'J44.9' WHEN 5 THEN 'I50' WHEN 6 THEN 'Z99' ELSE NULL END"


@query("op_K2_clinical_categories", sql(f"""SELECT "group", count(*) AS n FROM (SELECT unnest(list_filter([CASE WHEN c = 'E66.2' OR starts_with(c, 'J96') THEN 'RESPFAIL' END, CASE WHEN c IN ('E66.01', 'Z68.41', 'Z68.42') THEN 'OBESITY' END, CASE WHEN c IN ('94002', '94003', '94660') THEN 'VENTSUPPORT' END,
  CASE WHEN starts_with(c, 'J44') OR starts_with(c, 'I50') THEN 'PREDISPOSITION' END], lambda x: x IS NOT NULL)) AS "group" FROM (SELECT upper({_CODES}) AS c FROM ev)) GROUP BY 1"""))
def _(v):
    return clinical.category_rows(v.ev.select(F.expr(_CODES).alias("code"))).groupBy("group").agg(F.count("*").alias("n"))


@query("op_K7_clinical_vitals", sql("""SELECT patient_id, feature, CAST(value AS DOUBLE) AS value_std FROM (SELECT subject_id AS patient_id, feature, round(value, 2) AS value, row_number() OVER (PARTITION BY subject_id, feature ORDER BY ts, encounter_id, event_id) AS r FROM (
  SELECT *, row_number() OVER (PARTITION BY subject_id, encounter_id, feature ORDER BY ts, event_id) AS q FROM (
    SELECT subject_id, encounter_id, event_id, ts, 'value_HR' AS feature, value * 3 AS value FROM ev WHERE event_id % 2 = 0 AND value * 3 >= 15 AND value * 3 < 300
    UNION ALL SELECT subject_id, encounter_id, event_id, ts, 'value_BMI', value * 3 FROM ev WHERE event_id % 2 = 1 AND value * 3 >= 10 AND value * 3 < 100)) WHERE q = 1) WHERE r = 1"""))
def _(v):
    code = F.when(F.col("event_id") % 2 == 0, "8867-4").otherwise("39156-5")
    rows = v.ev.select(F.col("subject_id").alias("patient_id"), "encounter_id", code.alias("code"), (F.col("value") * 3).alias("value"), F.col("ts").alias("date"), F.col("event_id").alias("row_order"))
    return clinical.first_vitals(rows).select("patient_id", "feature", F.round(F.col("value_std").cast("double"), 2).alias("value_std"))
