"""Composite operators: encounters, events, cohorts, index events, features, statuses and ledgers (K1..K25)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.functions import scalar
from cairn.functions.temporal import boundaries, whole_days
from cairn.operators import joins
from cairn.operators.order import ranked_in_ranges
from cairn.operators.reduce import Order, asc, desc, keep_first
from cairn.operators.rules import predicate

# ---- encounters and events -------------------------------------------------


def reduce_encounters(enc: DataFrame, *, types: Sequence[str], not_before: str, end_default: str, order: Order) -> DataFrame:
    """One row per encounter: window and types first, then the earliest row, and only then the length-of-stay test.

    The order matters: an encounter whose earliest row is invalid is removed, not repaired by a later row.
    """
    kept = enc.filter(F.col("type").isin(*types) & (F.col("start") >= F.lit(not_before).cast("timestamp_ntz")))
    filled = kept.withColumn("end", F.coalesce("end", F.lit(end_default).cast("timestamp_ntz")))
    first = keep_first(filled, ["encounter_id"], order)
    return first.withColumn("los", whole_days(F.col("start"), F.col("end")) + 1).filter("los > 0")


def event_candidates(events: DataFrame, subjects: DataFrame, *, first: str, last: str, excluded_regions: Sequence[str]) -> DataFrame:
    """Events in ``[first, last]`` (the upper bound is that day's midnight) of subjects with no missing demographics."""
    window = F.col("ts").between(F.lit(first).cast("timestamp_ntz"), F.lit(last).cast("timestamp_ntz"))
    people = subjects.filter(~F.col("region").isin(*excluded_regions)).na.drop("any")
    return events.filter(window).na.drop(subset=["subject_id", "ts"]).join(people, "subject_id")


def cohort(candidates: DataFrame, encounters: DataFrame, *, adult: int = 18, oldest: int = 110, by: Sequence[str] = ("category", "type")) -> DataFrame:
    """Earliest event per subject, category and setting: adults, inside an encounter's interval."""
    age = F.year("ts") - F.col("birth_year")
    inside = joins.within(candidates, encounters.select("subject_id", "encounter_id", "start", "end", "type"), ["subject_id"], (F.col("ts") >= F.col("start")) & (F.col("ts") <= F.col("end")))
    return keep_first(inside.withColumn("age", age).filter((F.col("age") >= adult) & (F.col("age") < oldest)), ["subject_id", *by], [asc("ts"), asc("event_id"), asc("encounter_id")])


def encounter_flags(encounters: DataFrame, categories: Mapping[str, DataFrame], key: str = "encounter_id") -> DataFrame:
    """One flag per category: is the encounter among its members?"""
    flags = reduce(DataFrame.unionByName, [m.select(key, F.lit(name).alias("c")).distinct() for name, m in categories.items()])
    wide = flags.groupBy(key).agg(*[F.bool_or(F.col("c") == name).alias(name) for name in categories])
    return encounters.join(wide, key, "left").na.fill(False, list(categories))


def index_events(candidates: DataFrame, follow: DataFrame, *, first_days: int, last_days: int) -> DataFrame:
    """First qualifying event per subject, with the first later confirmation in the window and whether there is one."""
    index = keep_first(candidates, ["subject_id"], [asc("ts"), asc("event_id")]).select("subject_id", F.col("event_id").alias("index_id"), F.col("ts").alias("index_ts"), F.col("value").alias("index_value"))
    later = follow.select("subject_id", F.col("event_id").alias("follow_id"), F.col("ts").alias("follow_ts"), F.col("value").alias("follow_value"))
    found = joins.as_of_forward(index, later, ["subject_id"], left_ts="index_ts", right_ts="follow_ts", first_days=first_days, last_days=last_days, values=["follow_id", "follow_ts", "follow_value"], tie="follow_id", left_id=["index_id"])
    return found.withColumn("persistent", F.col("follow_id").isNotNull())


def candidate_status(df: DataFrame, ladder: Sequence[tuple[Column, str]]) -> DataFrame:
    """``status`` and the first ``reason`` that excludes a row."""
    from cairn.operators.rules import first_reason

    status, reason = first_reason(*ladder)
    return df.withColumn("status", status).withColumn("reason", reason)


def choose_measure(index: DataFrame, measures: DataFrame, keys: Sequence[str], *, index_id: str, index_ts: str, ts: str, rank: str, tie: str) -> DataFrame:
    """One measure per index event by source rank, then nearness in seconds, then ``tie``; measures without a time take no part.

    No pairs are made.  A subject's best rank decides for all its events; among
    those measures the nearest one is the last before or the first after the
    event, found by walking the subject's one sequence in both directions.
    """
    best = measures.filter(F.col(ts).isNotNull()).groupBy(*keys).agg(F.min(rank).alias(rank))
    theirs = [c for c in measures.columns if c not in keys]
    second = lambda c: F.date_trunc("second", F.col(c))
    a = index.select(*keys, second(index_ts).alias("_at"), F.struct(*index.columns).alias("_i"))
    b = measures.filter(F.col(ts).isNotNull()).join(best, [*keys, rank]).select(*keys, second(ts).alias("_at"), F.struct(*[F.col(c) for c in theirs]).alias("_m"), F.col(tie).alias("_tie"))
    both = a.unionByName(b, allowMissingColumns=True)
    seen = lambda *order: F.last("_m", ignorenulls=True).over(Window.partitionBy(*keys).orderBy(*order, F.col("_i").isNotNull(), F.col("_tie").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    both = both.withColumn("_before", seen(F.col("_at").asc())).withColumn("_after", seen(F.col("_at").desc())).filter("_i IS NOT NULL")
    gap = lambda m: F.abs(boundaries("second", F.col(f"_i.{index_ts}"), F.col(f"{m}.{ts}")))
    pick = F.least(*[F.when(F.col(m).isNotNull(), F.struct(gap(m).alias("s"), F.col(f"{m}.{tie}").alias("t"), F.col(m).alias("m"))) for m in ("_before", "_after")])
    return both.withColumn("_p", pick).filter("_p IS NOT NULL").select(*[F.col(f"_i.{c}").alias(c) for c in index.columns], *[F.col(f"_p.m.{c}").alias(c) for c in theirs], F.col("_p.s").alias("seconds"))


def pair_measures(left: DataFrame, right: DataFrame, keys: Sequence[str], *, left_id: str, left_ts: str, right_ts: str, hours: int, tie: str) -> DataFrame:
    """Weight and height style pairing: the nearest partner within ``hours``; only rows of the same or neighbouring spans of that length meet."""
    span = lambda c: F.floor(boundaries("hour", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(c)) / hours).cast("long")
    gap = F.abs(boundaries("second", F.col(left_ts), F.col(right_ts)))
    a = left.withColumn("_span", F.explode(F.array(span(left_ts) - 1, span(left_ts), span(left_ts) + 1)))
    hits = joins.within(a, right.withColumn("_span", span(right_ts)), [*keys, "_span"], gap <= hours * 3600).drop("_span").withColumn("gap_seconds", gap)
    return keep_first(hits, [left_id], [F.col("gap_seconds").asc(), asc(tie)])


# ---- features ---------------------------------------------------------------


def first_features(rows: DataFrame, *, value: str = "value", patient: str = "subject_id", encounter: str = "encounter_id", ts: str = "ts", tie: str = "event_id", feature: str = "code") -> DataFrame:
    """Long form of first values per patient and feature, by encounter first; one pass for all features."""
    keyed = keep_first(rows, [patient, encounter, feature], [asc(ts), asc(tie)])
    return keep_first(keyed, [patient, feature], [asc(ts), asc(encounter), asc(tie)]).select(patient, feature, value, ts)


def wide_features(long: DataFrame, features: Sequence[str], *, patient: str = "subject_id", feature: str = "code", value: str = "value", ts: str = "ts") -> DataFrame:
    """Wide table of values and days from the long form: one aggregation instead of one join for each feature."""
    aggs = []
    for f in features:
        aggs.append(F.max(F.when(F.col(feature) == f, F.col(value))).alias(f"value_{f}"))
        aggs.append(F.date_format(F.max(F.when(F.col(feature) == f, F.col(ts))), "yyyy-MM-dd").alias(f"date_{f}"))
    return long.groupBy(patient).agg(*aggs)


def previous_value(cohort_rows: DataFrame, rows: DataFrame, *, patient: str = "subject_id", left_ts: str = "index_ts", encounter: str = "encounter_id") -> DataFrame:
    """Latest value before the index, outside the index encounters."""
    outside = joins.anti(rows, cohort_rows, [encounter]) if encounter in cohort_rows.columns else rows
    right = outside.select(patient, F.col("ts").alias("prev_ts"), F.col("value").alias("prev_value"), F.col("event_id").alias("prev_id"))
    return joins.as_of_backward(cohort_rows, right, [patient], left_ts=left_ts, right_ts="prev_ts", values=["prev_value", "prev_ts", "prev_id"], tie="prev_id")


def first_last_dates(rows: DataFrame, keys: Sequence[str], ts: str, group: str) -> DataFrame:
    """HAS flag, first and last day for each key and group, without joining two reductions."""
    return rows.groupBy(*keys, group).agg(F.lit(True).alias("has"), F.date_format(F.min(ts), "yyyy-MM-dd").alias("first_date"), F.date_format(F.max(ts), "yyyy-MM-dd").alias("last_date"))


def finalise(df: DataFrame, columns: Sequence[tuple[str, str, object]], order: Sequence[str], rename: Mapping[str, str] = {}) -> DataFrame:  # noqa: B006
    """The ordered output contract: renamed, missing columns added, types cast and gaps filled."""
    for old, new in rename.items():
        df = df.withColumnRenamed(old, new)
    made = []
    for name, kind, default in columns:
        c = F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)
        made.append((c if default is None else F.coalesce(c, F.lit(default).cast(kind))).alias(name))
    return df.select(*made).orderBy(*order)


# ---- statuses, tiers, ledger --------------------------------------------------


def statuses(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """``<name>_status`` for each tri-state rule: met or indeterminate."""
    return df.withColumns({f"{name}_status": scalar.status(test) for name, test in rules.items()})


def ladder(*steps: tuple[Column, str], otherwise: str = "indeterminate") -> Column:
    out = None
    for test, name in steps:
        out = F.when(test, name) if out is None else out.when(test, name)
    return out.otherwise(otherwise) if out is not None else F.lit(otherwise)


def tiers(df: DataFrame, members: Mapping[str, Column]) -> DataFrame:
    """True-or-null indications, whether there is any, and how many."""
    df = df.withColumns({name: F.when(test, F.lit(True)) for name, test in members.items()})
    flags = [F.col(name) for name in members]
    return df.withColumn("any_indication", scalar.any_true(*flags)).withColumn("n_indications", scalar.count_true(*flags))


def overlap(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """How many rows have each combination of true flags."""
    key = F.concat_ws("+", *[F.when(F.col(f), F.lit(f)) for f in flags])
    return df.groupBy(F.when(key == "", "none").otherwise(key).alias("combination")).agg(F.count("*").alias("n"))


def evidence(sources: Mapping[str, DataFrame], *, key: str, ts: str, tie: str, columns: Sequence[str]) -> DataFrame:
    """Evidence ledger: supporting rows of every domain, ranked newest first inside key and domain."""
    rows = reduce(DataFrame.unionByName, [df.select(key, F.lit(domain).alias("domain"), ts, tie, *columns) for domain, df in sources.items()])
    return ranked_in_ranges(rows, [key, "domain"], [desc(ts), asc(tie)], "evidence_rank")



LEDGER = ("evidence_id", "tier", "evidence_type", "status", "certainty", "ts", "record_id", "evidence_rank")


def ledger(sources: Mapping[str, DataFrame], derived: DataFrame, *, key: str, statuses: Sequence[str], indications: Mapping[str, str]) -> DataFrame:
    """All evidence in one table: source rows of every component, derived statuses and derived indications.

    ``sources``: component -> (key, ts, record_id); all are ranked together,
    newest first inside key and component, so a hot key is many ranges.
    ``derived``: one row for each key with its ``statuses`` (a certainty where
    there is ``x_certainty`` for ``x_status``) and ``indications`` (column -> tier; null
    ones give no row); all its branches come from one scan.
    """
    rows = reduce(DataFrame.unionByName, [df.select(key, F.lit(f"source:{name}").alias("evidence_id"), "ts", F.col("record_id").cast("string").alias("record_id")) for name, df in sources.items()])
    seen = ranked_in_ranges(rows, [key, "evidence_id"], [desc("ts"), asc("record_id")], "evidence_rank")
    seen = seen.withColumns({"tier": F.lit("component"), "evidence_type": F.lit("source_record"), "status": F.lit("met"), "certainty": F.lit("strict")})

    def branch(name: str, tier: str, kind: str, status: Column, certainty: Column) -> Column:
        return F.struct(F.lit(name).alias("evidence_id"), F.lit(tier).alias("tier"), F.lit(kind).alias("evidence_type"), status.alias("status"), certainty.alias("certainty"))

    branches = []
    for column in statuses:
        own = column.removesuffix("_status") + "_certainty"
        sure = F.col(own) if own in derived.columns else F.when(F.col(column).isin("met", "not_met"), "strict").otherwise("not_applicable")
        branches.append(branch(f"status:{column}", "component", "derived_status", F.col(column), sure))
    for column, tier in indications.items():
        told = branch(column, tier, "derived_rule", F.when(F.col(column), "met").otherwise("not_met"), F.lit("strict"))
        branches.append(F.when(F.col(column).isNotNull(), told))
    made = derived.select(key, F.inline(F.array_compact(F.array(*branches))))
    made = made.withColumns({"ts": F.lit(None).cast(seen.schema["ts"].dataType), "record_id": F.lit(None).cast("string"), "evidence_rank": F.lit(1)})
    return seen.select(key, *LEDGER).unionByName(made.select(key, *LEDGER))


# ---- capture ----------------------------------------------------------------


def capture(df: DataFrame, catalog: Sequence[tuple], path: str, *, key: str, subject: str, code: str, system: str, ts: str) -> dict[str, DataFrame]:
    """Source rows that any included rule matches, their memberships, and observability of all rows: one scan, one partitioned write.

    ``catalog``: (rule, domain, code_system, code, match_type, include).  Each
    row is tagged with the parts that it belongs to; the parts are folders of
    one output, read back by themselves.
    """
    by_rule: dict[str, list[tuple]] = {}
    for rule, _, code_system, value, kind, include in catalog:
        if include:
            by_rule.setdefault(rule, []).append((code_system, value, kind))
    matched = F.array_compact(F.array(*[F.when(predicate(tests, F.col(code), F.col(system)), F.lit(rule)) for rule, tests in by_rule.items()]))
    row = lambda part, rule, n: F.struct(F.lit(part).alias("part"), rule.cast("string").alias("rule"), n.cast("long").alias("n"))
    none = F.lit(None)
    parts = F.concat(
        F.when(F.size("_rules") > 0, F.array(row("source", none, none))).otherwise(F.array()),
        F.transform("_rules", lambda r: row("membership", r, none)),
        F.array(row("observability", none, F.lit(1))),
    )
    tagged = df.withColumn("_rules", matched).select(key, subject, code, system, F.col(ts), F.to_date(ts).alias("day"), F.inline(parts))
    tagged.write.partitionBy("part").parquet(path)
    read = lambda part: df.sparkSession.read.parquet(f"{path}/part={part}")
    return {"source": read("source").drop("rule", "n", "day"), "membership": read("membership").select(key, "rule"), "observability": read("observability").select(subject, "day", "n")}
