"""Screening, BMI choice, product validation and table catalogs on small cases with known answers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cairn.operators import product, rules, screening

T = dt.datetime(2024, 3, 1, 8)
H, M, D = dt.timedelta(hours=1), dt.timedelta(minutes=1), dt.timedelta(days=1)
MEASURES = "patient_id long, encounter_id long, record_id string, concept string, value double, ts timestamp_ntz, kind string, usable boolean, plausible boolean, specimen string, specimen_id string, panel_id string"
VISITS = "patient_id long, encounter_id long, encounter_type string, encounter_start timestamp_ntz, encounter_end timestamp_ntz, end_kind string, record_id string"


def co2(e, rid, value, ts, kind="timestamp", usable=True, plausible=True, specimen="artery", sid=None, concept="arterial_pco2", p=1):
    return (p, e, rid, concept, value, ts, kind, usable, plausible, specimen, sid, None)


def ph(e, rid, value, ts, **more):
    return co2(e, rid, value, ts, concept="arterial_ph", **more)


def test_reasons_flags_and_pairs(spark):
    visits = [(1, e, "EMER", T + e * 10 * D, T + e * 10 * D + D, "timestamp", f"v{e}") for e in range(1, 14)]
    visits[2] = (1, 3, "AMB", *visits[2][3:])
    visits += [(1, 1, "EMER", T + 11 * D, None, "timestamp", "later"), (2, 20, "IMP", T, None, "timestamp", "v"), (3, 21, "IMP", T, None, "timestamp", "v"), (4, 22, "IMP", T, None, "timestamp", "v")]
    at = lambda e: T + e * 10 * D
    rows = [
        co2(1, "a", 60.0, at(1) + H), co2(1, "b", 40.0, at(1) + 2 * H), ph(1, "c", 7.40, at(1) + H + 20 * M), ph(1, "d", 7.30, at(1) + H - 20 * M), ph(1, "e", 7.1, at(1) + 3 * H),  # a tie of 20 minutes: the smaller record id
        co2(2, "a", 40.0, at(2) + H), co2(2, "b", 80.0, at(2) + 5 * H), ph(2, "c", 7.4, at(2) + H),  # elevated later
        co2(3, "a", 60.0, at(3) + H), ph(3, "b", 7.4, at(3) + H),  # out of scope
        co2(4, "a", 60.0, at(4) + H, usable=False), co2(4, "b", 70.0, at(4) + 2 * H), ph(4, "c", 7.4, at(4) + H),  # the first decides
        co2(5, "a", 60.0, at(5) + H, plausible=False), ph(5, "c", 7.4, at(5) + H),
        co2(6, "a", 60.0, at(6) + H), ph(6, "b", 7.4, at(6) + H + 31 * M),  # too far
        co2(7, "a", 60.0, at(7) + H), ph(7, "b", 7.5, at(7) + H),  # too high
        co2(8, "a", 60.0, at(8) + H, concept="venous_pco2"),  # the other source alone
        co2(9, "a", 60.0, at(9) + 25 * H), co2(10, "a", 60.0, at(10).replace(hour=0), kind="date_only", specimen="Venous line"), ph(10, "b", 7.2, at(10) + 9 * H),  # no result in the window; by day
        co2(11, "a", 60.0, at(11) + H, sid="s"), ph(11, "b", 7.4, at(11) + H), ph(11, "c", 7.36, at(11) + 9 * H, sid="s"),  # the specimen beats the time
        co2(12, "a", 50.0, at(12) + H, sid=""), ph(12, "b", 7.42, at(12) + 2 * H, sid=""), ph(12, "c", 7.41, at(12) + 95 * M),  # an empty specimen is none
        co2(20, "a", 60.0, T + H, p=2), ph(20, "b", 7.4, T + H, p=2), co2(21, "a", 60.0, T + H, p=3), ph(21, "b", 7.4, T + H, p=3), co2(22, "a", 51.0, T + H, p=4), ph(22, "b", 7.4, T + 70 * M, p=4),
    ]
    patients = spark.createDataFrame([(1, 1950, "r1"), (1, 2020, "r2"), (2, None, "r"), (3, 2010, "r"), (4, 1990, "r")], "patient_id long, year_of_birth int, record_id string")
    out = {r["encounter_id"]: r for r in screening.candidates(spark.createDataFrame(visits, VISITS), patients, spark.createDataFrame(rows, MEASURES)).collect()}
    assert {e: r["reason"] for e, r in out.items()} == {
        1: None, 2: "first_arterial_pco2_not_elevated", 3: "encounter_type_out_of_scope", 4: "first_arterial_pco2_unit_unusable", 5: "first_arterial_pco2_implausible", 6: "missing_paired_ph", 7: "paired_ph_above_maximum",
        8: "no_arterial_pco2", 10: None, 11: None, 12: "missing_paired_ph", 20: "missing_age", 21: "age_under_minimum", 22: None,
    }
    assert (out[1]["abg_ph"], out[1]["pairing_method"], out[1]["pairing_minutes"], out[1]["is_first"], out[1]["age_at_index"]) == (7.40, "nearest_within_tolerance", 20, True, 74)
    assert out[2]["elevated_later"] and out[2]["maximum_in_encounter"] == 80 and not out[2]["elevated"]
    assert out[6]["without_companion"] and out[8]["other_source_only"] and out[4]["unusable_or_implausible"] and not out[3]["eligible"]
    assert (out[10]["pairing_method"], out[10]["pairing_quality"], out[10]["pairing_minutes"], out[10]["acute"], out[10]["probably_other_specimen"]) == ("same_date_date_only", "date_only", None, True, True)
    assert (out[11]["abg_ph"], out[11]["pairing_quality"], out[11]["compensated"]) == (7.36, "highest", True)
    assert out[12]["pairing_method"] is None and [e for e, r in out.items() if r["is_first"]] == [1, 22]
    assert (out[22]["elevated_ge50"], out[22]["elevated_ge52"]) == (True, False)


def test_bmi_sources_in_order(spark):
    index = spark.createDataFrame([(f"i{p}", p, 10 * p, T, T + D, "timestamp") for p in range(1, 7)], "index_event_id string, patient_id long, encounter_id long, index_ts timestamp_ntz, encounter_end timestamp_ntz, end_kind string")
    day0 = dt.datetime(2024, 3, 1)
    vitals = [
        (1, None, "a", "bmi", "31", "kg/m2", T - 30 * D, "timestamp"), (1, None, "b", "bmi", "45", "KG/M2", T - 300 * D, "timestamp"), (1, 10, "c", "bmi", "50", "kg/m2", T + H, "timestamp"),
        (2, 20, "a", "weight", "220.46226218", "lbs", T - 2 * D, "timestamp"), (2, 20, "b", "height", "2", "m", T - 2 * D + 3 * H, "timestamp"), (2, 20, "c", "height", "160", "cm", T - 2 * D + 4 * H, "timestamp"), (2, 20, "d", "bmi", "70", "kg/m2", T + H, "timestamp"),
        (3, 30, "a", "bmi", "36", "kg/m2", T + 2 * H, "timestamp"), (3, 31, "b", "bmi", "60", "kg/m2", T + H, "timestamp"), (3, 30, "c", "bmi", "9", "kg/m2", T, "timestamp"),
        (4, None, "a", "bmi", "28", "kg/m2", day0 - 365 * D, "date_only"), (5, None, "a", "bmi", "28", "kg/m2", T - 365 * D - M, "timestamp"), (5, None, "b", "bmi", "n/a", "kg/m2", T - D, "timestamp"), (5, None, "c", "bmi", "30", "stone", T - D, "timestamp"),
    ]
    rows = spark.createDataFrame(vitals, "patient_id long, encounter_id long, record_id string, concept string, value string, unit string, ts timestamp_ntz, kind string")
    out = {r["patient_id"]: r for r in screening.choose_bmi(index, rows).collect()}
    got = {p: (round(r["bmi"], 4) if r["bmi"] else None, r["bmi_source"], r["obesity_class"], r["obesity_status"]) for p, r in out.items()}
    assert got == {
        1: (31.0, "measured_pre_index", "class_I", "met"), 2: (25.0, "calculated_height_weight", "not_obese", "not_met"), 3: (36.0, "measured_index_encounter", "class_II", "met"),
        4: (28.0, "measured_pre_index", "not_obese", "not_met"), 5: (None, None, None, "indeterminate"), 6: (None, None, None, "indeterminate"),
    }
    assert out[2]["weight_kg"] == pytest.approx(100) and out[2]["height_m"] == 2 and out[4]["bmi_days_from_index"] == -365 and out[5]["bmi_ge27"] is None


def test_product_of_the_right_form_has_no_errors(spark):
    labs = spark.createDataFrame([("r1", "labs", "f", 1)], "record_id string, domain string, source_file string, row_number long")
    made = {
        "manifest": spark.createDataFrame([("complete",)], "status string"), "labs": labs, "observations": spark.createDataFrame([("k", "A", "A")], "output_key string, category string, label string"), "memberships": spark.range(1),
        "output_manifest": spark.createDataFrame([("k", 1, None, "category")], "output_key string, row_count long, digest string, columns string"), "element_catalog": spark.createDataFrame([("e", "source_concept")], "element_id string, element_kind string"),
        "element_rule": spark.createDataFrame([("e", True)], "element_id string, include boolean"), "element_membership": spark.createDataFrame([("e", "r1", "labs", True)], "element_id string, record_id string, domain string, include boolean"),
        "inventory": spark.createDataFrame([("f", "labs")], "path string, domain string"),
    }
    contract = product.Contract(required=tuple(made), sources={"labs": "labs"}, manifest={"status": "complete"}, outputs=("k",), output_columns=("category",), schemas={"labs": "record_id string, domain string, source_file string, row_number bigint"})
    found = product.validate(spark, made, contract).collect()
    assert len(found) >= 20 and {r["error"] for r in found if r["n"]} == set()
    wrong = product.validate(spark, {**made, "output_manifest": made["output_manifest"].withColumn("digest", F.lit("1")), "labs": labs.unionByName(labs).limit(2)}, contract)
    assert {r["error"] for r in wrong.collect() if r["n"]} == {"output_manifest.digest", "duplicate_record_ids"}
    assert {r["error"] for r in product.validate(spark, {"labs": labs.limit(0)}, contract).collect() if r["n"]} == {"missing_tables", "empty.labs"}


def test_table_catalogs_are_checked_where_they_are_read(spark):
    kind = "rule string, domain string, code_system string, code string, match_type string, include boolean"
    good = rules.catalog_from(spark.createDataFrame([("a", "d", "ANY", " A1 ", "Exact", None), ("", "d", "ANY", "B", "exact", True)], kind))
    assert [tuple(r) for r in good.collect()] == [("a", "d", "ANY", "A1", "exact", True)]
    with pytest.raises(Exception, match="unknown match_type like"):
        rules.catalog_from(spark.createDataFrame([("a", "d", "ANY", "A", "like", True)], kind)).collect()
    with pytest.raises(Exception, match="catalog: key .* is not unique"):
        rules.catalog_from(spark.createDataFrame([("a", "d", "ANY", "A", "exact", True)] * 2, kind)).collect()


def test_values_are_normalised_once_in_compiled_code(spark):
    """A filter on plausible values keeps to the JVM's limit of 8,000 bytes for compiled methods, and the joins read written rows; before, each value was worked out up to six times, interpreted, for each join."""
    rows = [(1, 1, str(i), c, v, u, T, "timestamp") for i, (c, v, u) in enumerate([("bmi", "10", " KG/M²"), ("bmi", "9.99", "kg/m2"), ("weight", "1e2", "Pounds"), ("height", "180", "CM "), ("height", "70", "in"), ("height", "2.51", "m"), ("weight", "x", "kg"), ("weight", "50", None), ("pulse", "50", "kg"), (None, "50", "kg")])]
    vitals = spark.createDataFrame(rows, "patient_id long, encounter_id long, record_id string, concept string, value string, unit string, ts timestamp_ntz, kind string")
    out = screening.anthropometrics(vitals)
    assert [(r["normalised"], r["plausible"]) for r in out.orderBy(F.col("record_id").cast("int")).collect()] == [
        (10.0, True), (9.99, False), (100 * 0.45359237, True), (1.8, True), (70 * 0.0254, True), (2.51, False), (None, False), (None, False), (None, False), (None, False),
    ]
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    made = debug.codegenStringSeq(out.filter("plausible AND concept = 'weight'").select("record_id", "normalised")._jdf.queryExecution().executedPlan())
    assert made.size() and max(made.apply(i)._3().maxMethodCodeSize() for i in range(made.size())) < 8_000
    index = spark.createDataFrame([("i", 1, 1, T, T + D, "timestamp")], "index_event_id string, patient_id long, encounter_id long, index_ts timestamp_ntz, encounter_end timestamp_ntz, end_kind string")
    chosen = screening.choose_bmi(index, vitals)
    assert "ExistingRDD" not in chosen._jdf.queryExecution().toString() and chosen.first()["bmi"] == 10.0
