"""Clinical vocabulary and derived statuses on top of the generic operators (K1, K2, K7, K21, K22).

The tables below are fixed values; everything that acts on them is generic.
Statuses are three-valued: missing evidence is 'indeterminate' and never
'not_met', and an indication is true or null unless its rule says otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.functions.scalar import KPA_TO_MMHG_SHORT, fib4, number, status, to_celsius, to_fahrenheit
from cairn.operators import rules
from cairn.operators.reduce import asc, keep_first

# Vital signs by feature: codes, lowest value, upper bound (exclusive), conversion.
VITALS: dict[str, tuple[tuple[str, ...], float, float, str | None]] = {
    "value_759878": (("75987-8",), 20, 43, "celsius"),
    "value_608356": (("60835-6",), 20, 43.3, "celsius"),
    "value_27110": (("74105-8", "51731-8", "19224-5", "2711-0"), 0, 100, None),
    "value_27086": (("2708-6", "51733-4"), 0, 100, None),
    "value_205641": (("2713-6", "20564-1"), 0, 100, None),
    "value_Weight": (("29463-7", "3141-9", "3142-7", "8335-2"), 10, 450, None),
    "value_New_Temp": (("8310-5", "8331-1", "75539-7", "8333-7"), 43.3, 110, "fahrenheit"),
    "value_BMI": (("39156-5",), 10, 100, None),
    "value_RR": (("9279-1",), 2, 75, None),
    "value_SysBP": (("8480-6",), 30, 350, None),
    "value_DiaBP": (("8462-4",), 15, 250, None),
    "value_SPO2": (("59408-5", "20564-1"), 30, 100, None),
    "value_HR": (("8893-0", "8867-4"), 15, 300, None),
    "value_Height": (("8302-2", "8306-3", "8301-4", "3138-5", "8308-9", "8305-5", "3137-7"), 54, 84, None),
}

# Code rules of the qualifying event categories, and the accepted pressure units.
CATEGORY_RULES = {
    "RESPFAIL": rules.CodeRule("RESPFAIL", exact=("E66.2",), prefixes=("J96",)),
    "OBESITY": rules.CodeRule("OBESITY", exact=("E66.01", "Z68.41", "Z68.42")),
    "VENTSUPPORT": rules.CodeRule("VENTSUPPORT", exact=(
        "5A09357", "5A09358", "5A09359", "5A0935B", "5A0935Z", "5A09457", "5A09458", "5A09459", "5A0945B", "5A0945Z", "5A09557", "5A09558",
        "5A09559", "5A0955B", "5A0955Z", "5A1935Z", "5A1945Z", "5A1955Z", "1014859", "1015098", "94002", "94003", "94660")),
    "PREDISPOSITION": rules.CodeRule("PREDISPOSITION", prefixes=(
        "D75.1", "E84", "F11", "G12.21", "G35", "G36", "G37", "G47.3", "G70", "G71", "G95", "I27.1", "I27.2", "I27.81", "I27.9", "I50", "J43", "J44", "J45", "S14.1", "T40")),
}
PCO2_UNITS = {"mmhg": 1.0, "mm[hg]": 1.0, "mm hg": 1.0, "kpa": KPA_TO_MMHG_SHORT}
PCO2_LOW, PCO2_HIGH = 45.0, 200.0
OBESITY_BMI = rules.NumericRule("OBESITY_BMI", exact=("39156-5",), low=40.0, high=100.0, closed_low=True)


def gas_rule(name: str, codes: Sequence[str], low: float = PCO2_LOW) -> rules.NumericRule:
    """An open pressure interval in mmHg, LOINC only."""
    return rules.NumericRule(name, exact=tuple(codes), systems=("LOINC",), low=low, high=PCO2_HIGH, units=PCO2_UNITS)


def vital_rows(df: DataFrame, *, code: str = "code", value: str = "value") -> DataFrame:
    """Valid vital values in long form, from one scan: a row for each feature whose codes and range accept the row."""
    v = number(_c(value))
    hits = []
    for feature, (codes, low, high, convert) in VITALS.items():
        x = {"celsius": to_celsius, "fahrenheit": to_fahrenheit}[convert](v) if convert else v
        accepted = rules.CodeRule(feature, codes).mask(_c(code)) & (x >= low) & (x < high)
        hits.append(F.when(accepted, F.struct(F.lit(feature).alias("feature"), x.cast("float").alias("value_std"))))
    known = sorted({c for codes, *_ in VITALS.values() for c in codes})
    rows = df.filter(rules.CodeRule("any", known).mask(_c(code)))
    return rows.withColumn("_hit", F.explode(F.array_compact(F.array(*hits)))).select(*df.columns, "_hit.feature", "_hit.value_std")


def category_rows(df: DataFrame, *, code: str = "code") -> DataFrame:
    """Rows tagged with each event category whose rule matches; distinct codes are classified once."""
    return rules.split_groups(df, CATEGORY_RULES, code=code)


def first_vitals(df: DataFrame, *, patient: str = "patient_id", encounter: str = "encounter_id", ts: str = "date", tie: str = "row_order") -> DataFrame:
    """First valid value of each vital by encounter, then by patient."""
    rows = vital_rows(df)
    inner = keep_first(rows, [patient, encounter, "feature"], [asc(ts), asc(tie)])
    return keep_first(inner, [patient, "feature"], [asc(ts), asc(encounter), asc(tie)]).select(patient, "feature", "value_std", ts)


# ---- statuses ------------------------------------------------------------------------------------------

# Statuses that are met by any of some documented features, else indeterminate.
ANY_OF: dict[str, tuple[str, ...]] = {
    "prior_mi_status": ("dx_prior_mi",),
    "prior_ischemic_stroke_status": ("dx_ischemic_stroke",),
    "pad_status": ("dx_pad",),
    "symptomatic_pad_status": ("dx_symptomatic_pad", "proc_lower_revascularization"),
    "established_cvd_any_status": ("dx_prior_mi", "dx_ischemic_stroke", "dx_pad", "proc_lower_revascularization"),
    "ckd_any_status": ("egfr_persistent_lt60", "dx_ckd_any", "dx_eskd"),
    "ckd_stage_3a_plus_status": ("dx_ckd_stage_3a_plus", "dx_eskd", "egfr_persistent_lt60"),
    "osa_any_status": ("dx_osa",),
    "mash_status": ("dx_mash",),
    "cirrhosis_status": ("dx_cirrhosis",),
    "heart_failure_status": ("dx_heart_failure",),
    "hypertension_status": ("dx_hypertension",),
    "ohs_documented_status": ("dx_ohs",),
    "pcos_status": ("dx_pcos",),
    "knee_oa_status": ("dx_knee_oa",),
    "aud_status": ("dx_aud",),
    "iih_status": ("dx_iih",),
    "binge_eating_status": ("dx_binge_eating",),
    "masld_status": ("dx_masld",),
    "dyslipidemia_status": ("dx_dyslipidemia",),
    "metabolic_syndrome_status": ("dx_metabolic_syndrome",),
    "copd_status": ("dx_copd",),
    "asthma_status": ("dx_asthma",),
    "neuromuscular_disease_status": ("dx_neuromuscular",),
    "chest_wall_disease_status": ("dx_chest_wall",),
}


def first_of(*steps: tuple[str, Column], otherwise: str | None = None) -> Column:
    """The first label whose test is true."""
    out = None
    for label, test in steps:
        out = F.when(test, label) if out is None else out.when(test, label)
    return out.otherwise(otherwise) if otherwise is not None else out


def _c(name: str) -> Column:
    return F.col(name)


# Statuses that follow from measured components as well as codes.  The labels and thresholds are the output
# contract; each is the label of the first test that is true, else the last entry.
LADDERS: dict[str, tuple[tuple[tuple[str, str], ...], str | None]] = {
    "t2d_status": ((("met", "dx_t2d OR diabetes_range_a1c_dates >= 2"),), "indeterminate"),
    "t2d_certainty": ((("strict", "dx_t2d"), ("probable", "diabetes_range_a1c_dates >= 2")), "not_applicable"),
    "prediabetes_status": ((("not_met", "dx_t2d OR diabetes_range_a1c_dates >= 2"), ("met", "dx_prediabetes OR a1c_latest BETWEEN 5.7 AND 6.4"), ("not_met", "a1c_latest < 5.7")), "indeterminate"),
    "ckd_stage": ((("ESKD", "dx_eskd"), ("3a_plus", "dx_ckd_stage_3a_plus")), None),
    "osa_moderate_severe_status": ((("met", "ahi_rei_value >= 15"), ("not_met", "ahi_rei_value < 15")), "indeterminate"),
    "osa_severity": ((("severe", "ahi_rei_value >= 30"), ("moderate", "ahi_rei_value >= 15"), ("mild", "ahi_rei_value >= 5"), ("none", "ahi_rei_value IS NOT NULL")), "indeterminate"),
    "mash_f2_f3_status": ((("met", "dx_mash AND NOT dx_cirrhosis AND fibrosis_stage IN ('F2', 'F3')"), ("not_met", "dx_mash AND (dx_cirrhosis OR fibrosis_stage IN ('F0', 'F1', 'F4'))")), "indeterminate"),
    "mash_f2_f3_certainty": ((("strict", "dx_mash AND fibrosis_stage IS NOT NULL"),), "not_applicable"),
    "fibrosis_method": ((("biopsy", "fibrosis_stage IS NOT NULL AND proc_liver_biopsy"), ("elastography", "fibrosis_stage IS NOT NULL AND proc_elastography"), ("structured_stage_result", "fibrosis_stage IS NOT NULL"), ("biopsy_without_stage", "proc_liver_biopsy"), ("elastography_without_stage", "proc_elastography")), None),
    "hfpef_status": ((("met", "dx_heart_failure AND lvef >= 50"), ("not_met", "lvef < 50"), ("met", "dx_hfpef")), "indeterminate"),
    "hfpef_certainty": ((("strict", "dx_heart_failure AND lvef >= 50"), ("code_only", "dx_hfpef")), "not_applicable"),
    "uncontrolled_hypertension_two_meds_status": ((("indeterminate", "latest_sbp IS NULL AND latest_dbp IS NULL"), ("met", "(latest_sbp > 140 OR latest_dbp > 90) AND active_antihypertensive_ingredient_count >= 2")), "not_met"),
    "probable_ohs_status": ((("met", "bmi_ge30 AND (compensated_hypercapnia OR persistent_hypercapnia_14_84d) AND (dx_osa OR proc_polysomnography OR proc_hsat) AND NOT dx_neuromuscular AND NOT dx_chest_wall"),), "indeterminate"),
    "metabolic_dysfunction_status": ((("met", "antipsychotic_active AND (bmi_ge27 OR a1c_latest >= 5.7 OR dx_metabolic_syndrome)"), ("not_met", "antipsychotic_active")), "indeterminate"),
}


def laddered(steps: Sequence[tuple[str, str]], otherwise: str | None) -> Column:
    return first_of(*[(label, F.expr(test)) for label, test in steps], otherwise=otherwise)


def with_statuses(features: DataFrame) -> DataFrame:
    """All statuses in one projection over the feature table."""
    either = {name: status(_any(members)) for name, members in ANY_OF.items()}
    laddered_ones = {name: laddered(*ladder) for name, ladder in LADDERS.items()}
    index = fib4(_c("age_at_index"), _c("ast_latest"), _c("alt_latest"), _c("platelets_latest"))
    return features.withColumns({**either, **laddered_ones, "fib4_latest": index})


def _any(members: Sequence[str]) -> Column:
    out = _c(members[0])
    for m in members[1:]:
        out = out | _c(m)
    return out


# ---- indications ------------------------------------------------------------------------------------------

# Indications by tier: the body-mass flag they need (or none) and the statuses that must be met, with their list labels.
INDICATIONS: dict[str, dict[str, tuple[str | None, tuple[str, ...], str]]] = {
    "fda": {
        "ind_fda_t2d": (None, ("t2d_status",), "t2d"),
        "ind_fda_obesity_established_cvd": ("bmi_ge27", ("established_cvd_any_status",), "obesity_established_cvd"),
        "ind_fda_t2d_ckd": (None, ("t2d_status", "ckd_any_status"), "t2d_ckd"),
        "ind_fda_moderate_severe_osa": ("bmi_ge30", ("osa_moderate_severe_status",), "moderate_severe_osa"),
        "ind_fda_noncirrhotic_mash_f2_f3": ("bmi_ge27", ("mash_f2_f3_status", "no_cirrhosis"), "mash_f2_f3"),
    },
    "guideline": {
        "ind_guideline_weight_loss_for_probable_ohs": ("bmi_ge30", ("probable_ohs_status",), "probable_ohs"),
        "ind_guideline_obesity_related_hfpef": ("bmi_ge30", ("strict_hfpef",), "obesity_hfpef"),
        "ind_guideline_pcos_with_overweight_obesity": ("bmi_ge27", ("pcos_status",), "pcos_obesity"),
    },
    "rct": {
        "ind_rct_obesity_related_hfpef": ("bmi_ge30", ("strict_hfpef",), "obesity_hfpef"),
        "ind_rct_symptomatic_pad_t2d": (None, ("t2d_status", "symptomatic_pad_status"), "symptomatic_pad_t2d"),
        "ind_rct_knee_oa_obesity": ("bmi_ge30", ("knee_oa_status",), "knee_oa_obesity"),
        "ind_rct_alcohol_use_disorder": (None, ("aud_status",), "alcohol_use_disorder"),
        "ind_rct_idiopathic_intracranial_hypertension": ("bmi_ge27", ("iih_status",), "iih"),
        "ind_rct_antipsychotic_metabolic": (None, ("metabolic_dysfunction_status",), "antipsychotic_metabolic"),
        "ind_rct_pcos_obesity": ("bmi_ge27", ("pcos_status",), "pcos_obesity"),
    },
}
# Statuses that open the weight-management label from a BMI of 27, and the bridge branches.
LABEL_COMORBIDITIES = ("t2d_status", "prediabetes_status", "hypertension_status", "dyslipidemia_status", "osa_any_status", "established_cvd_any_status")
BRIDGE_30 = {"strict_hfpef": "hfpef", "uncontrolled_hypertension_two_meds_status": "uncontrolled_hypertension_two_meds", "ckd_stage_3a_plus_status": "ckd_3a_plus"}
BRIDGE_27 = {"prediabetes_status": "prediabetes", "prior_mi_status": "prior_mi", "prior_ischemic_stroke_status": "prior_stroke", "symptomatic_pad_status": "symptomatic_pad"}


def _met(name: str) -> Column:
    if name == "strict_hfpef":
        return (_c("hfpef_status") == "met") & (_c("hfpef_certainty") == "strict")
    if name == "no_cirrhosis":
        return _c("cirrhosis_status") != "met"
    return _c(name) == "met"


def _some(names: Mapping[str, str] | Sequence[str]) -> Column:
    tests = [_met(n) for n in names]
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


# The further routes, in the order of their definition; each may use those before it.
ROUTES: dict[str, tuple[tuple[tuple[str, str], ...], str | None]] = {
    "bridge_clinical_criteria_status": ((("met", "bridge_qualifying_branch IS NOT NULL"), ("not_met", "bmi_valid AND NOT bmi_ge27")), "indeterminate"),
    "bridge_certainty": ((("strict", "bridge_clinical_criteria_status IN ('met', 'not_met')"),), "not_applicable"),
    "bridge_partd_exclusion_status": ((("met", "ind_fda_disease_specific_any"), ("not_met", "bridge_clinical_criteria_status = 'met'")), "indeterminate"),
    "part_d_disease_route_status": ((("met", "ind_fda_disease_specific_any"),), "indeterminate"),
    "payer_route_model": ((("part_d_disease_route", "ind_fda_disease_specific_any"), ("bridge_clinical_route", "bridge_clinical_criteria_status = 'met'"), ("weight_label_only", "ind_fda_weight_management"), ("potential_bridge_but_indeterminate", "bridge_clinical_criteria_status = 'indeterminate'")), "no_documented_route"),
}


def _tier(df: DataFrame, tier: str, members: Mapping[str, tuple[str | None, tuple[str, ...], str]]) -> DataFrame:
    """A tier's indications (true or null), whether there is any, how many and which."""
    made = {}
    for name, (bmi_flag, needed, _) in members.items():
        tests = [_met(n) for n in needed] + ([_c(bmi_flag)] if bmi_flag else [])
        made[name] = F.when(reduce(Column.__and__, tests), F.lit(True))
    total = F.aggregate(F.array(*[F.coalesce(_c(n), F.lit(False)).cast("int") for n in members]), F.lit(0), lambda a, b: a + b)
    return df.withColumns(made).withColumns({
        "ind_fda_disease_specific_any" if tier == "fda" else f"ind_{tier}_any": F.coalesce(*[_c(n) for n in members]),
        f"num_{tier}_indication_groups": total,
        f"{tier}_indication_group_list": F.concat_ws(";", *[F.when(_c(n), F.lit(label)) for n, (*_, label) in members.items()]),
    })


def with_indications(statuses: DataFrame) -> DataFrame:
    """Indications of three tiers with counts and lists, the bridge branches and the payer route, each from its table."""
    label = first_of(("true", _c("bmi_ge30") | (_c("bmi_ge27") & _some(LABEL_COMORBIDITIES))), ("false", _c("bmi_valid"))).cast("boolean")
    df = statuses.withColumns({"ind_fda_weight_management": label, "ind_fda_weight_management_certainty": first_of(("strict", _c("bmi_valid")), otherwise="not_applicable")})
    for tier, members in INDICATIONS.items():
        df = _tier(df, tier, members)
    branches = {"bmi_ge35": _c("bmi_ge35"), "bmi_ge30_comorbidity": _c("bmi_ge30") & _some(BRIDGE_30), "bmi_ge27_comorbidity": _c("bmi_ge27") & _some(BRIDGE_27)}
    listed = F.concat_ws(";", *[F.when(_met(n), F.lit(name)) for n, name in {**BRIDGE_30, **BRIDGE_27}.items()])
    df = df.withColumns({"bridge_qualifying_branch": first_of(*branches.items()), "bridge_qualifying_components": listed})
    return reduce(lambda out, route: out.withColumn(route, laddered(*ROUTES[route])), ROUTES, df)
