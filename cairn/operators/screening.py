"""Screening of encounters by a first measurement (K16) and choice of a body mass index (K18).

Measurements are long: one row for each, with ``concept``, ``value``, ``usable`` (unit) and
``plausible`` flags, ``ts`` with its precision in ``kind``, and a record id that breaks ties.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn import shared
from cairn.functions import scalar
from cairn.functions.temporal import DATE_ONLY, TIMESTAMP, boundaries, day, days_from, in_look_back, inclusive_end
from cairn.operators import joins
from cairn.operators.reduce import asc, keep_first


@dataclass(frozen=True)
class Screen:
    """What is screened for.  Fixed values: limits, names of concepts, pairing methods and qualities, and reasons."""

    subject: str = "arterial_pco2"
    other_source: str = "venous_pco2"
    companion: str = "arterial_ph"
    supplements: tuple[tuple[str, str], ...] = (("abg_hco3", "arterial_hco3"), ("abg_po2", "arterial_po2"), ("abg_sao2", "arterial_sao2"))
    above: float = 45.0
    sensitivities: tuple[float, ...] = (50.0, 52.0)
    companion_low: float = 7.35
    companion_high: float = 7.45
    window_hours: int = 24
    pair_minutes: int = 30
    date_only_pairs: bool = True
    other_source_cohort: bool = True
    adult: int = 18
    types: tuple[str, ...] = ("EMER", "IMP")
    first_day: str | None = None
    last_day: str | None = None
    pairing: tuple[tuple[str, str], ...] = (("same_specimen_or_panel", "highest"), ("exact_timestamp", "high"), ("nearest_within_tolerance", "moderate"), ("same_date_date_only", "date_only"))


ENCOUNTER = ("patient_id", "encounter_id")
_RESULT = ("ts", "kind", "value", "usable", "plausible", "record_id", "specimen", "specimen_id", "panel_id")


def _is_date(kind: Column) -> Column:
    return kind == DATE_ONLY


def _between(ts: Column, kind: Column, start: Column, stop: Column) -> Column:
    """Inside [start, stop]; a measurement without a time of day counts by its day."""
    return ts.between(start, stop) | (_is_date(kind) & day(ts).between(day(start), day(stop)))


def _first(concept: str) -> Column:
    """The encounter's first result of a concept in its window, before anything is asked of its unit or value."""
    here = (F.col("concept") == concept) & F.col("in_window")
    return F.min_by(F.struct(*_RESULT), F.when(here, F.struct("ts", "record_id")))


def _same(a: str, b: str) -> Column:
    return F.coalesce((F.col(a) != "") & (F.col(a) == F.col(b)), F.lit(False))


def _level(screen: Screen) -> Column:
    """How well a companion matches the first result: the number of the pairing method, null for none."""
    timed = ~_is_date(F.col("first.kind")) & ~_is_date(F.col("kind"))
    gap = F.abs(boundaries("minute", F.col("first.ts"), F.col("ts")))
    tests = [
        _same("first.specimen_id", "specimen_id") | _same("first.panel_id", "panel_id"),
        timed & (F.col("first.ts") == F.col("ts")),
        timed & (gap <= screen.pair_minutes),
        F.lit(screen.date_only_pairs) & ~timed & (day(F.col("first.ts")) == day(F.col("ts"))),
    ]
    return reduce(lambda out, step: out.when(step[1], step[0]), enumerate(tests, 1), F)


def companions(first: DataFrame, measures: DataFrame, screen: Screen) -> DataFrame:
    """For each encounter with a first result: its paired companion and supplements, each the best by method, then minutes, then record id.

    One aggregation over the encounter's usable, plausible measurements; both
    sides are partitioned by encounter already.
    """
    wanted = [screen.companion, *(c for _, c in screen.supplements)]
    minutes = F.when(~_is_date(F.col("first.kind")) & ~_is_date(F.col("kind")), F.abs(boundaries("minute", F.col("first.ts"), F.col("ts"))))
    pairs = measures.filter(F.col("concept").isin(wanted) & F.col("usable") & F.col("plausible")).join(first, list(ENCOUNTER))
    pairs = pairs.withColumn("level", _level(screen)).withColumn("minutes", minutes).filter("level is not null")
    order = F.struct("level", F.col("minutes").isNull(), "minutes", "record_id")
    best = lambda concept, what: F.min_by(what, F.when(F.col("concept") == concept, order))
    return pairs.groupBy(*ENCOUNTER).agg(
        best(screen.companion, F.struct("value", "level", "minutes")).alias("companion"),
        *[best(concept, F.col("value")).alias(name) for name, concept in screen.supplements],
    )


def _reasons(screen: Screen) -> list[tuple[Column, str]]:
    """The ladder: an encounter is excluded for the first reason that holds."""
    day_of = F.to_date("encounter_start")
    outside = [day_of < F.lit(screen.first_day).cast("date")] if screen.first_day else []
    outside += [day_of > F.lit(screen.last_day).cast("date")] if screen.last_day else []
    return [
        (F.col("year_of_birth").isNull(), "missing_age"),
        (F.col("age_at_index") < screen.adult, "age_under_minimum"),
        (~F.upper(F.trim("encounter_type")).isin(*screen.types), "encounter_type_out_of_scope"),
        (reduce(Column.__or__, outside, F.lit(False)), "outside_study_period"),
        (F.col("first").isNull(), "no_arterial_pco2"),
        (~F.coalesce("first.usable", F.lit(False)), "first_arterial_pco2_unit_unusable"),
        (~F.coalesce("first.plausible", F.lit(False)), "first_arterial_pco2_implausible"),
        (F.col("first.value") <= screen.above, "first_arterial_pco2_not_elevated"),
        (F.col("companion.value").isNull(), "missing_paired_ph"),
        (F.col("companion.value") > screen.companion_high, "paired_ph_above_maximum"),
    ]


def candidates(encounters: DataFrame, patients: DataFrame, measures: DataFrame, screen: Screen = Screen()) -> DataFrame:
    """Candidate encounters with their first result, paired companions, sensitivity flags, status, first reason and whether it is the patient's first.

    ``encounters``: patient_id, encounter_id, encounter_type, encounter_start,
    encounter_end, end_kind, record_id; ``patients``: patient_id, year_of_birth,
    record_id, and what is to be carried.  Repeated encounters and patients count
    once, by earliest start and record id.

    Scale: everything but the patients meets by (patient, encounter), so
    measurements are shuffled once for the windows and once for the pairs, and a
    patient with a third of all rows is as many groups as they have encounters.
    """
    enc = keep_first(encounters.filter("encounter_id is not null and patient_id is not null"), ENCOUNTER, [asc("encounter_start"), asc("record_id")]).drop("record_id")
    known = keep_first(patients.filter("patient_id is not null"), ["patient_id"], [asc("record_id")]).drop("record_id")
    start = F.col("encounter_start")
    end = F.coalesce(inclusive_end(F.col("encounter_end"), F.col("end_kind")), days_from(start, 1))
    gas = measures.filter(F.col("concept").isin(screen.subject, screen.other_source)).join(enc.select(*ENCOUNTER, "encounter_start", "encounter_end", "end_kind"), list(ENCOUNTER))
    gas = gas.withColumn("in_window", _between(F.col("ts"), F.col("kind"), start, start + F.expr(f"INTERVAL '{screen.window_hours}' HOUR")))
    in_stay = (F.col("concept") == screen.subject) & F.col("usable") & F.col("plausible") & _between(F.col("ts"), F.col("kind"), start, end)
    results = gas.groupBy(*ENCOUNTER).agg(_first(screen.subject).alias("first"), _first(screen.other_source).alias("other"), F.max(F.when(in_stay, F.col("value"))).alias("maximum"))
    paired = companions(results.filter("first is not null").select(*ENCOUNTER, "first"), measures, screen)
    other_high = F.coalesce(F.col("other.usable") & F.col("other.plausible") & (F.col("other.value") > screen.above), F.lit(False))
    rows = enc.join(results, list(ENCOUNTER)).filter(F.col("first").isNotNull() | (F.lit(screen.other_source_cohort) & other_high))
    rows = rows.join(paired, list(ENCOUNTER), "left").join(known, "patient_id", "left").withColumn("age_at_index", F.year("encounter_start") - F.col("year_of_birth"))

    value, valid = F.col("first.value"), F.coalesce(F.col("first.usable") & F.col("first.plausible"), F.lit(False))
    flag = lambda test: F.coalesce(test, F.lit(False))
    ph = F.col("companion.value")
    ladder = _reasons(screen)
    reason = reduce(lambda out, step: out.when(*step), ladder, F)
    eligible = flag(reduce(Column.__and__, [~test for test, _ in ladder[:4]]))
    # asked for outright: element_at takes the level of a null struct for a value
    level = lambda which: F.when(F.col("companion").isNotNull(), F.element_at(F.array(*[F.lit(m[which]) for m in screen.pairing]), F.col("companion.level")))
    judged = rows.select(
        scalar.record_id(F.lit("index-v1"), F.col("patient_id"), F.col("encounter_id"), F.date_format(start, "yyyy-MM-dd HH:mm:ss")).alias("index_event_id"),
        "patient_id", "encounter_id", "encounter_type", "encounter_start", "encounter_end", "end_kind", *[c for c in known.columns if c != "patient_id"], "age_at_index",
        value.alias("abg_pco2"), F.col("first.ts").alias("abg_ts"), F.col("first.kind").alias("abg_kind"), F.col("first.record_id").alias("abg_record_id"), ph.alias("abg_ph"),
        *[name for name, _ in screen.supplements],
        level(0).alias("pairing_method"), level(1).alias("pairing_quality"), F.col("companion.minutes").alias("pairing_minutes"),
        F.col("maximum").alias("maximum_in_encounter"), F.col("first").isNotNull().alias("first_in_window"),
        flag(valid & (value > screen.above)).alias("elevated"), *[flag(valid & (value >= limit)).alias(f"elevated_ge{limit:.0f}") for limit in screen.sensitivities],
        flag(ph < screen.companion_low).alias("acute"), flag((value > screen.above) & ph.between(screen.companion_low, screen.companion_high)).alias("compensated"),
        flag(valid & (value > screen.above) & ph.isNull()).alias("without_companion"),
        flag(valid & (value <= screen.above) & (F.col("maximum") > screen.above)).alias("elevated_later"),
        (F.col("first").isNull() & other_high).alias("other_source_only"),
        flag(F.lower(F.trim("first.specimen")).rlike("venous|vein|vbg")).alias("probably_other_specimen"),
        (F.col("first").isNotNull() & ~valid).alias("unusable_or_implausible"),
        eligible.alias("eligible"), F.when(reason.isNull(), "included").otherwise("excluded").alias("status"), reason.alias("reason"),
    )
    w = Window.partitionBy("patient_id").orderBy(F.col("status") != "included", "encounter_start", "index_event_id")
    return judged.withColumn("is_first", (F.row_number().over(w) == 1) & (F.col("status") == "included"))


# ---- body mass index ------------------------------------------------------------------------------

# Units and their factors to kg/m2, kg and m, and the plausible ranges.
UNITS = {
    "bmi": {"kg/m2": 1.0, "kg/m^2": 1.0, "kg/m²": 1.0, "kg per m2": 1.0, "kg/meter2": 1.0},
    "weight": {"kg": 1.0, "kilogram": 1.0, "kilograms": 1.0, "lb": 0.45359237, "lbs": 0.45359237, "pound": 0.45359237, "pounds": 0.45359237},
    "height": {"m": 1.0, "meter": 1.0, "meters": 1.0, "cm": 0.01, "centimeter": 0.01, "centimeters": 0.01, "in": 0.0254, "inch": 0.0254, "inches": 0.0254},
}
RANGES = {"bmi": (10.0, 100.0), "weight": (20.0, 500.0), "height": (1.0, 2.5)}
#: Sources by rank: measured before the index, calculated before it, measured later in the index encounter.
SOURCES = ("measured_pre_index", "calculated_height_weight", "measured_index_encounter")


def anthropometrics(vitals: DataFrame) -> DataFrame:
    """``vitals`` (concept, value, unit, ...) with ``normalised`` and ``plausible``; an unknown unit gives null, and false."""
    unit, concept = F.lower(F.trim(F.coalesce("unit", F.lit("")))), F.col("concept")
    # hundredths divide, as 0.01 isn't a binary number
    table = lambda c, pick: F.create_map(*[F.lit(x) for name, factor in UNITS[c].items() for x in (name, pick(factor))])[unit]
    for_concept = lambda value: reduce(lambda rest, c: rest.when(concept == c, value(c)), UNITS, F)
    times = for_concept(lambda c: table(c, lambda f: 1.0 if f == 0.01 else f))
    parts = for_concept(lambda c: table(c, lambda f: 100.0 if f == 0.01 else 1.0) if 0.01 in UNITS[c].values() else F.lit(1.0))
    out = scalar.number(F.col("value")) * times / parts
    fits = F.coalesce(F.col("normalised").between(*[for_concept(lambda c: F.lit(RANGES[c][side])) for side in (0, 1)]), F.lit(False))  # noqa: B023
    # exploded, so that filters on it aren't rewritten to work it out once for each bound: too long a method for the JVM to compile
    return vitals.withColumn("normalised", F.explode(F.array(out))).withColumn("plausible", fits)


def calculated_bmi(normalised: DataFrame, *, hours: int = 24) -> DataFrame:
    """(patient_id, encounter_id, ts, kind, bmi, weight_kg, height_m, record_id): each weight with the nearest height of the same encounter within the hours whose quotient is plausible."""
    some = normalised.filter("plausible").withColumn("visit", F.coalesce(F.col("encounter_id").cast("string"), F.lit("")))
    side = lambda concept, p: some.filter(F.col("concept") == concept).select("patient_id", "visit", *[F.col(c).alias(f"{p}_{c}") for c in ("encounter_id", "ts", "kind", "normalised", "record_id")])
    weight, height = side("weight", "w"), side("height", "h").drop("h_encounter_id")
    quotient = scalar.bmi(F.col("w_normalised"), F.col("h_normalised"))
    near = F.abs(boundaries("hour", F.col("w_ts"), F.col("h_ts"))) <= hours
    reach = F.expr(f"INTERVAL '{hours + 1}' HOUR")
    pairs = joins.within_cells(weight, height, ["patient_id", "visit"], start=F.col("w_ts") - reach, stop=F.col("w_ts") + reach, ts="h_ts", cell=3_600 * 2 * (hours + 1), test=near & quotient.between(*RANGES["bmi"]))
    best = keep_first(pairs, ["w_record_id"], [F.abs(boundaries("second", F.col("w_ts"), F.col("h_ts"))).asc(), asc("h_record_id")])
    kind = F.when(F.col("w_ts") > F.col("h_ts"), F.col("w_kind")).when(F.col("h_ts") > F.col("w_ts"), F.col("h_kind")).when(_is_date(F.col("w_kind")) | _is_date(F.col("h_kind")), DATE_ONLY).otherwise(TIMESTAMP)
    return best.select("patient_id", F.col("w_encounter_id").alias("encounter_id"), F.greatest("w_ts", "h_ts").alias("ts"), kind.alias("kind"), quotient.alias("bmi"), F.col("w_normalised").alias("weight_kg"), F.col("h_normalised").alias("height_m"), F.concat_ws(":", "w_record_id", "h_record_id").alias("record_id"))


def choose_bmi(index: DataFrame, vitals: DataFrame, *, look_back: int = 365, fallback: bool = True) -> DataFrame:
    """``index`` rows (index_event_id, patient_id, encounter_id, index_ts, encounter_end, end_kind) with the BMI to use, its source and class.

    Measured values up to ``look_back`` days before the index come first, then those
    calculated from weight and height, then measured ones later in the index
    encounter; inside a source the nearest in time.  Look-backs are joined by time
    cells, so a patient's whole history never meets.

    The index rows and the plausible values, which several joins read, are written
    once to the shared folder: neither is worked out again for each of them.
    """
    spark = index.sparkSession
    index = shared.written(spark, index, "index")
    normalised = anthropometrics(vitals).filter("plausible").select("patient_id", "encounter_id", "record_id", "concept", "ts", "kind", "normalised", "plausible")
    normalised = shared.written(spark, normalised, "vitals")
    measured = normalised.filter("concept = 'bmi'").select("patient_id", "encounter_id", "ts", "kind", F.col("normalised").alias("bmi"), F.lit(None).cast("double").alias("weight_kg"), F.lit(None).cast("double").alias("height_m"), "record_id")
    mine = index.select("index_event_id", "patient_id", F.col("encounter_id").alias("index_encounter"), "index_ts", "encounter_end", "end_kind")
    at, ts = F.col("index_ts"), F.col("ts")
    lower = F.when(_is_date(F.col("kind")), day(ts) >= days_from(day(at), -look_back)).otherwise(ts >= days_from(at, -look_back))
    found = []
    for rank, values in ((1, measured), (2, calculated_bmi(normalised))):
        near = joins.within_cells(mine, values, ["patient_id"], start=days_from(day(at), -look_back), stop=at, ts="ts", cell=86_400 * look_back, test=(ts <= at) & lower)
        found.append(near.withColumn("source_rank", F.lit(rank)))
    if fallback:
        until = F.coalesce(inclusive_end(F.col("encounter_end"), F.col("end_kind")), days_from(at, 1))
        later = mine.join(measured.withColumnRenamed("encounter_id", "index_encounter"), ["patient_id", "index_encounter"]).filter((ts > at) & (ts <= until))
        found.append(later.withColumn("source_rank", F.lit(3)))
    columns = ["index_event_id", "index_ts", "ts", "bmi", "weight_kg", "height_m", "record_id", "source_rank"]
    every = reduce(DataFrame.unionByName, [df.select(*columns) for df in found])
    best = keep_first(every, ["index_event_id"], [asc("source_rank"), F.abs(boundaries("second", ts, at)).asc(), asc("record_id")])
    source = F.element_at(F.array(*map(F.lit, SOURCES)), F.col("source_rank"))
    out = index.join(best.select("index_event_id", F.col("ts").alias("bmi_ts"), "bmi", source.alias("bmi_source"), "weight_kg", "height_m", F.col("record_id").alias("bmi_record_id")), "index_event_id", "left")
    b = F.col("bmi")
    classes = F.when(b >= 40, "class_III").when(b >= 35, "class_II").when(b >= 30, "class_I").when(b.isNotNull(), "not_obese")
    status = F.when(b.isNull(), "indeterminate").when(b >= 30, "met").otherwise("not_met")
    days = F.datediff(F.to_date("bmi_ts"), F.to_date("index_ts"))
    return out.withColumns({"bmi_days_from_index": days, **{f"bmi_ge{limit}": b >= limit for limit in (27, 30, 35, 40)}, "obesity_class": classes, "obesity_status": status, "obesity_certainty": F.when(b.isNull(), "not_applicable").otherwise("strict")})
