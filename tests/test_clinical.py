"""Clinical statuses and indications on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from cairn.operators import clinical

NUMBERS = ("diabetes_range_a1c_dates", "a1c_latest", "ahi_rei_value", "lvef", "latest_sbp", "latest_dbp", "active_antihypertensive_ingredient_count", "age_at_index", "ast_latest", "alt_latest", "platelets_latest")
FLAGS = sorted({m for ms in clinical.ANY_OF.values() for m in ms} | {"dx_t2d", "dx_prediabetes", "proc_liver_biopsy", "proc_elastography", "dx_hfpef", "compensated_hypercapnia", "persistent_hypercapnia_14_84d", "proc_polysomnography", "proc_hsat", "antipsychotic_active"})
BMI = ("bmi_valid", "bmi_ge27", "bmi_ge30", "bmi_ge35")


@pytest.fixture(scope="module")
def judge(spark):
    def run(bmi=None, **facts):
        row = {n: None for n in NUMBERS} | {f: False for f in FLAGS} | {"fibrosis_stage": None}
        row |= {"bmi_valid": bmi is not None} | {f"bmi_ge{n}": None if bmi is None else bmi >= n for n in (27, 30, 35)} | facts
        schema = ", ".join([f"{n} double" for n in NUMBERS] + [f"{f} boolean" for f in (*FLAGS, *BMI)] + ["fibrosis_stage string"])
        names = [x.split()[0] for x in schema.split(", ")]
        df = spark.createDataFrame([tuple(float(row[n]) if n in NUMBERS and row[n] is not None else row[n] for n in names)], schema)
        return clinical.with_indications(clinical.with_statuses(df)).first()

    return run


def test_nothing_known_is_indeterminate(judge):
    r = judge()
    assert all(r[s] == "indeterminate" for s in clinical.ANY_OF)
    assert r["ind_fda_weight_management"] is None and r["payer_route_model"] == "potential_bridge_but_indeterminate"
    assert r["ind_fda_disease_specific_any"] is None and r["num_rct_indication_groups"] == 0 and r["fda_indication_group_list"] == ""


def test_diabetes_and_prediabetes(judge):
    assert judge(a1c_latest=6.0)["prediabetes_status"] == "met"
    assert judge(a1c_latest=5.0)["prediabetes_status"] == "not_met"
    r = judge(dx_t2d=True, a1c_latest=6.0, dx_ckd_any=True)
    assert (r["t2d_status"], r["t2d_certainty"], r["prediabetes_status"]) == ("met", "strict", "not_met")
    assert r["fda_indication_group_list"] == "t2d;t2d_ckd" and r["num_fda_indication_groups"] == 2 and r["payer_route_model"] == "part_d_disease_route"
    assert judge(diabetes_range_a1c_dates=2)["t2d_certainty"] == "probable"


def test_measured_fraction_outranks_code(judge):
    assert judge(lvef=40, dx_hfpef=True)["hfpef_status"] == "not_met"
    assert judge(dx_hfpef=True)["hfpef_certainty"] == "code_only"
    r = judge(bmi=31, lvef=55, dx_heart_failure=True)
    assert r["hfpef_certainty"] == "strict" and r["bridge_qualifying_branch"] == "bmi_ge30_comorbidity" and r["guideline_indication_group_list"] == "obesity_hfpef"


def test_blood_pressure_falls_through(judge):
    assert judge()["uncontrolled_hypertension_two_meds_status"] == "indeterminate"
    assert judge(latest_sbp=120)["uncontrolled_hypertension_two_meds_status"] == "not_met"
    for drugs, want in ((1, "not_met"), (2, "met")):
        assert judge(latest_sbp=150, active_antihypertensive_ingredient_count=drugs)["uncontrolled_hypertension_two_meds_status"] == want


def test_liver(judge):
    assert judge(dx_mash=True)["mash_f2_f3_status"] == "indeterminate"
    assert judge(dx_mash=True, fibrosis_stage="F2", bmi=28)["ind_fda_noncirrhotic_mash_f2_f3"] is True
    assert judge(dx_mash=True, fibrosis_stage="F2", dx_cirrhosis=True)["mash_f2_f3_status"] == "not_met"
    assert judge(proc_liver_biopsy=True)["fibrosis_method"] == "biopsy_without_stage"
    assert judge(age_at_index=50, ast_latest=40, alt_latest=25, platelets_latest=200)["fib4_latest"] == 2.0


def test_weight_label_and_routes(judge):
    assert judge(bmi=26)["payer_route_model"] == "no_documented_route" and judge(bmi=26)["ind_fda_weight_management"] is False
    assert judge(bmi=28)["ind_fda_weight_management"] is False
    assert judge(bmi=28, dx_hypertension=True)["payer_route_model"] == "weight_label_only"
    assert judge(bmi=36)["payer_route_model"] == "bridge_clinical_route" and judge(bmi=36)["bridge_partd_exclusion_status"] == "not_met"
    assert judge(bmi=28, antipsychotic_active=True)["metabolic_dysfunction_status"] == "met"
    assert judge(bmi=20, antipsychotic_active=True)["metabolic_dysfunction_status"] == "not_met"


def test_vitals_and_categories(spark):
    rows = [("p", "e", "8310-5", "37", 1), ("p", "e", "8310-5", "300", 2), ("p", "e", "20564-1", "97", 3), ("p", "e", "8302-2", "54", 4), ("p", "e", "8302-2", "84", 5), ("p", "e", "zzz", "1", 6)]
    df = spark.createDataFrame(rows, "patient_id string, encounter_id string, code string, value string, row_order int").withColumn("date", F.col("row_order"))
    got = {(r["feature"], round(r["value_std"], 1)) for r in clinical.first_vitals(df).collect()}
    assert got == {("value_New_Temp", 98.6), ("value_205641", 97.0), ("value_SPO2", 97.0), ("value_Height", 54.0)}
    codes = spark.createDataFrame([("j96.01",), ("E66.2",), ("Z68.41",), ("94660",), ("J44.9",), ("X",)], "code string")
    assert sorted((r["code"], r["group"]) for r in clinical.category_rows(codes).collect()) == [("94660", "VENTSUPPORT"), ("E66.2", "RESPFAIL"), ("J44.9", "PREDISPOSITION"), ("Z68.41", "OBESITY"), ("j96.01", "RESPFAIL")]
    gas = spark.createDataFrame([("2019-8", "LOINC", "45", "mmHg"), ("2019-8", "LOINC", "46", "mmHg"), ("2019-8", "LOINC", "7", "kPa"), ("2019-8", "LOINC", "200", "mmHg"), ("2019-8", "CPT", "50", "mmHg")], "code string, system string, v string, u string")
    from cairn.operators.rules import numeric_rule

    out = numeric_rule(gas, clinical.gas_rule("ABG", ["2019-8"]), code="code", value="v", unit="u", system="system")
    assert [r["outcome"] for r in out.collect()] == ["rejected_range", "accepted", "accepted", "rejected_range", "rejected_system"]
