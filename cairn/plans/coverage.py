"""Further queries: sources, variants and reporting forms of the inventory, each with its own SQL form."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairn.functions import scalar, temporal
from cairn.operators import aggregate, cohort, joins, reduce, rules
from cairn.operators.reduce import asc, desc
from cairn.plans.composite import scratch
from cairn.plans.registry import query
from cairn.plans.relational import _INDEX, TS, _index, sec
from cairn.plans.roles import GROUPS, PRESSURE, RULES, RULES_CTE, sql, sql_rule_match, tables


def csv_folder(v, *frames) -> str:
    """The frames as CSV files with headers, each in a folder of its own."""
    from cairn.sources.writers import write_table

    root = scratch(v, "csv")
    for i, df in enumerate(frames):
        write_table(df, f"{root}/part_{i}", fmt="csv")
    return root


# ---- A ---------------------------------------------------------------------------------


@query("op_A1_discover", "SELECT count(*) AS rows FROM nation")
def _(v):
    from cairn.sources.readers import family_files, list_files, read_csv

    (nation,) = tables(v.spark, v.dir, "nation")
    files = family_files(list_files(v.spark, csv_folder(v, nation.repartition(3))))
    return read_csv(v.spark, files).agg(F.count("*").alias("rows"))


@query("op_A4_csv_scan", "SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name FROM nation WHERE n_regionkey = 1")
def _(v):
    from cairn.sources.readers import list_files, read_csv

    (nation,) = tables(v.spark, v.dir, "nation")
    df = read_csv(v.spark, list_files(v.spark, csv_folder(v, nation)), ["n_nationkey", "n_name", "n_regionkey"])
    return df.filter("n_regionkey = '1'").select("n_nationkey", "n_name")


@query("op_A7_csv_union_by_name", "SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name, CAST(NULL AS VARCHAR) AS extra FROM nation UNION ALL SELECT CAST(r_regionkey AS VARCHAR), r_name, 'r' FROM region")
def _(v):
    from cairn.sources.readers import list_files, read_csv

    nation, region = tables(v.spark, v.dir, "nation", "region")
    a = nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    b = region.select(F.lit("r").alias("extra"), F.col("r_name").alias("name"), F.col("r_regionkey").alias("id"))
    return read_csv(v.spark, list_files(v.spark, csv_folder(v, a, b)), ["id", "name", "extra"]).drop("_file")


@query("op_A10_resolve_table", "SELECT r_regionkey, r_name FROM region")
def _(v):
    from cairn.sources.readers import read_table

    return read_table(v.spark, f"{v.dir}/region", ["r_regionkey", "r_name"])


@query("op_A11_available_columns", "SELECT n_nationkey, n_name FROM nation")
def _(v):
    from cairn.sources.readers import available_columns

    (nation,) = tables(v.spark, v.dir, "nation")
    return nation.select(*available_columns(nation.columns, ["n_nationkey"], ["n_name", "n_comment"]))


@query("op_A13_open_product", "SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def _(v):
    from cairn.sources.manifests import schema_digest, write_manifest
    from cairn.sources.readers import open_product

    path = scratch(v, "product")
    frames = dict(zip(("nation", "region"), tables(v.spark, v.dir, "nation", "region")))
    for name, df in frames.items():
        df.write.parquet(f"{path}/{name}")
    write_manifest(v.spark, path, frames)
    back = open_product(v.spark, path, expected_schema_sha256=schema_digest(frames))
    return back["nation"].join(back["region"], F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "r_name")


@query("op_A14_selected_subjects", sql("SELECT event_id FROM ev WHERE subject_id IN (SELECT subject_id FROM subj WHERE segment = 'BUILDING')"))
def _(v):
    return joins.semi(v.ev, v.subj.filter("segment = 'BUILDING'"), ["subject_id"]).select("event_id")


@query("op_A18_inventory", "SELECT CAST(length(t) AS BIGINT) AS bytes, sha256(t) AS sha256 FROM (SELECT 'r_regionkey,r_name' || chr(10) || string_agg(CAST(r_regionkey AS VARCHAR) || ',' || r_name || chr(10), '' ORDER BY r_regionkey) AS t FROM region)")
def _(v):
    from cairn.sources.readers import inventory

    (region,) = tables(v.spark, v.dir, "region")
    return inventory(v.spark, csv_folder(v, region.select("r_regionkey", "r_name").coalesce(1).sortWithinPartitions("r_regionkey"))).select("bytes", "sha256")


# ---- B ------------------------------------------------------------------------------------


@query("op_B2_normalise_values", sql("SELECT event_id, TRY_CAST(raw_value AS DOUBLE) AS value, nullif(trim(unit), '') AS unit FROM ev"))
def _(v):
    return v.ev.select("event_id", scalar.number(F.col("raw_value")).alias("value"), F.nullif(F.trim("unit"), F.lit("")).alias("unit"))


@query("op_B4_normalise_codes", sql("SELECT event_id, upper(trim(system)) AS system, upper(trim(code2)) AS code FROM ev"))
def _(v):
    return v.ev.select("event_id", scalar.norm_code(F.col("system")).alias("system"), scalar.norm_code(F.col("code2")).alias("code"))


@query("op_B5_normalise_dates", sql(f"SELECT event_id, strftime(CASE WHEN raw_ts = 'bad' THEN NULL WHEN length(raw_ts) = 8 THEN strptime(raw_ts, '%Y%m%d') ELSE CAST(raw_ts AS TIMESTAMP) END, {TS}) AS ts FROM ev"))
def _(v):
    return v.ev.select("event_id", temporal.iso_second(temporal.parse_timestamp(F.col("raw_ts"))).alias("ts"))


@query("op_B9_domain_filters", sql("SELECT 'dx' AS domain, event_id FROM ev WHERE starts_with(code2, 'C') UNION ALL SELECT 'px', event_id FROM ev WHERE code2 IN ('E1', 'E2', 'E3')"))
def _(v):
    dx = v.ev.filter(rules.CodeRule("dx", (), ("c",)).mask(F.col("code2")))
    px = v.ev.filter(rules.CodeRule("px", ("E1", "e2", " E3 ")).mask(F.col("code2")))
    return dx.select(F.lit("dx").alias("domain"), "event_id").unionByName(px.select(F.lit("px").alias("domain"), "event_id"))


@query("op_B19_include_exclude", sql("SELECT event_id FROM ev WHERE subject_id IN (SELECT subject_id FROM subj WHERE sex = 'F') AND encounter_id NOT IN (SELECT encounter_id FROM ev WHERE code = 'signup')"))
def _(v):
    return joins.anti(joins.semi(v.ev, v.subj.filter("sex = 'F'"), ["subject_id"]), v.ev.filter("code = 'signup'"), ["encounter_id"]).select("event_id")


# ---- C --------------------------------------------------------------------------------------


@query("op_C2_unique_key_mapping", sql("SELECT r.rule, count(*) AS n FROM ev e JOIN (SELECT DISTINCT rule, code FROM rules WHERE include AND match_type = 'prefix') r ON starts_with(e.code2, r.code) GROUP BY 1", RULES_CTE))
def _(v):
    cat = rules.catalog(v.spark, [(r, d, "ANY", c, m, i) for r, d, s, c, m, i in RULES if m == "prefix"])
    return rules.match_codes(v.ev, cat, code="code2").groupBy("rule").agg(F.count("*").alias("n"))


@query("op_C8_candidate_left_filter", sql("SELECT n.encounter_id, s.sex, x.top FROM enc n LEFT JOIN subj s USING (subject_id) LEFT JOIN (SELECT encounter_id, max(value) AS top FROM ev GROUP BY 1) x USING (encounter_id) WHERE x.top > 20 OR s.birth_year < 1930"))
def _(v):
    top = v.ev.groupBy("encounter_id").agg(F.max("value").alias("top"))
    return v.enc.join(v.subj, "subject_id", "left").join(top, "encounter_id", "left").filter((F.col("top") > 20) | (F.col("birth_year") < 1930)).select("encounter_id", "sex", "top")


@query("op_C25_exact_membership", sql("SELECT count(*) AS n FROM enc WHERE encounter_id IN (SELECT encounter_id FROM ev)"))
def _(v):
    return joins.semi(v.enc, v.ev, ["encounter_id"]).agg(F.count("*").alias("n"))


@query("op_C27_file_dimension", "SELECT 'nations' AS source, CAST(n_nationkey AS VARCHAR) AS id FROM nation UNION ALL SELECT 'regions', CAST(r_regionkey AS VARCHAR) FROM region")
def _(v):
    from cairn.sources.readers import list_files, read_csv

    nation, region = tables(v.spark, v.dir, "nation", "region")
    files = list_files(v.spark, csv_folder(v, nation.select(F.col("n_nationkey").alias("id")), region.select(F.col("r_regionkey").alias("id"))))
    dimension = v.spark.createDataFrame([(f.rsplit("/", 1)[-1], "nations" if "/part_0/" in f else "regions") for f in files], "name string, source string")  # a row for each file
    return read_csv(v.spark, files, ["id"]).withColumn("name", F.element_at(F.split("_file", "/"), -1)).join(dimension, "name").select("source", "id")


@query("op_C30_evidence_join", sql("SELECT i.index_id, e.event_id FROM idx i JOIN ev e USING (subject_id) WHERE e.code = 'error'", _INDEX))
def _(v):
    return _index(v).join(v.ev.filter("code = 'error'").select("subject_id", "event_id"), "subject_id").select("index_id", "event_id")


# ---- D ----------------------------------------------------------------------------------------


@query("op_D7_partial_final", sql(f"SELECT code, CAST(sum(n) AS BIGINT) AS n, strftime(min(a), {TS}) AS first_ts FROM (SELECT code, encounter_id % 8 AS b, count(*) AS n, min(ts) AS a FROM ev GROUP BY 1, 2) GROUP BY 1"))
def _(v):
    part = v.ev.groupBy("code", (F.col("encounter_id") % 8).alias("b")).agg(F.count("*").alias("n"), F.min("ts").alias("a"))
    return part.groupBy("code").agg(F.sum("n").alias("n"), F.min("a").alias("first_ts")).select("code", "n", sec("first_ts"))


@query("op_D20_code_counts", sql("SELECT system, code2, count(*) AS n FROM ev GROUP BY 1, 2"))
def _(v):
    return v.ev.groupBy("system", "code2").agg(F.count("*").alias("n"))


# ---- E, F ---------------------------------------------------------------------------------------


@query("op_E4_best_pair", sql("SELECT ref, other FROM (SELECT a.event_id AS ref, b.event_id AS other, row_number() OVER (PARTITION BY a.event_id ORDER BY CASE WHEN a.encounter_id = b.encounter_id THEN 0 ELSE 1 END, abs(date_diff('minute', a.ts, b.ts)) NULLS LAST, b.event_id) AS r FROM ev a JOIN ev b ON a.subject_id = b.subject_id AND CAST(a.ts AS DATE) = CAST(b.ts AS DATE) WHERE a.code = 'purchase' AND b.code = 'view') WHERE r = 1"))
def _(v):
    a = v.ev.filter("code = 'purchase'").select("subject_id", F.to_date("ts").alias("d"), F.col("event_id").alias("ref"), F.col("ts").alias("ts1"), F.col("encounter_id").alias("e1"))
    b = v.ev.filter("code = 'view'").select("subject_id", F.to_date("ts").alias("d"), F.col("event_id").alias("other"), F.col("ts").alias("ts2"), F.col("encounter_id").alias("e2"))
    gap = F.abs(temporal.boundaries("minute", F.col("ts1"), F.col("ts2")))
    return reduce.keep_first(a.join(b, ["subject_id", "d"]), ["ref"], [F.when(F.col("e1") == F.col("e2"), 0).otherwise(1).asc(), gap.asc_nulls_last(), asc("other")]).select("ref", "other")


@query("op_E7_choice_by_distance", sql("SELECT index_id, event_id FROM (SELECT index_id, event_id, row_number() OVER (PARTITION BY index_id ORDER BY abs(date_diff('second', index_ts, ts)), event_id) AS r FROM idx JOIN ev USING (subject_id) WHERE code = 'click') WHERE r = 1", _INDEX))
def _(v):
    clicks = v.ev.filter("code = 'click'").select("subject_id", "event_id", "ts", F.lit(1).alias("one"))
    return cohort.choose_measure(_index(v), clicks, ["subject_id"], index_id="index_id", index_ts="index_ts", ts="ts", rank="one", tie="event_id").select("index_id", "event_id")


@query("op_E12_row_order", "SELECT event_id, row_number() OVER (ORDER BY event_id) AS row_order FROM events")
def _(v):
    from cairn.operators.order import row_order

    (e,) = tables(v.spark, v.dir, "events")
    return row_order(v.spark, e.select("event_id"), ["event_id"])


@query("op_E13_stable_first", sql("SELECT encounter_id, event_id FROM (SELECT encounter_id, event_id, row_number() OVER (PARTITION BY encounter_id ORDER BY date_trunc('day', ts), event_id) AS r FROM ev WHERE code <> 'view') WHERE r = 1"))
def _(v):
    return reduce.keep_first(v.ev.filter("code <> 'view'").withColumn("d", temporal.day(F.col("ts"))), ["encounter_id"], [asc("d"), asc("event_id")]).select("encounter_id", "event_id")


@query("op_F1_multi_key_sort", sql("SELECT subject_id, code, event_id FROM ev ORDER BY subject_id, code DESC, event_id"))
def _(v):
    return v.ev.select("subject_id", "code", "event_id").orderBy("subject_id", F.desc("code"), "event_id")


@query("op_F3_lateral_limit", sql("SELECT s.subject_id, l.event_id FROM subj s LEFT JOIN LATERAL (SELECT event_id FROM ev WHERE ev.subject_id = s.subject_id ORDER BY value DESC, event_id LIMIT 1) l ON true"))
def _(v):
    best = reduce.keep_first(v.ev, ["subject_id"], [desc("value"), asc("event_id")]).select("subject_id", "event_id")
    return v.subj.select("subject_id").join(best, "subject_id", "left")


@query("op_F5_topk_rows", sql("SELECT code, event_id FROM (SELECT code, event_id, row_number() OVER (PARTITION BY code ORDER BY value DESC, event_id) AS r FROM ev) WHERE r <= 20"))
def _(v):
    return reduce.top_k(v.ev, ["code"], [desc("value"), asc("event_id")], 20).select("code", "event_id")


@query("op_F8_report_order", sql("SELECT type, state, count(*) AS n FROM enc GROUP BY 1, 2 ORDER BY n DESC, 1, 2"))
def _(v):
    return v.enc.groupBy("type", "state").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "type", "state")


# ---- G, J -----------------------------------------------------------------------------------------


@query("op_G3_concat_events", sql("SELECT event_id, ts > TIMESTAMP '2024-01-15' AS late FROM ev WHERE code = 'click' UNION ALL SELECT event_id, ts > TIMESTAMP '2024-01-15' FROM ev WHERE code2 = 'C5'"))
def _(v):
    late = lambda df: df.select("event_id", (F.col("ts") > F.lit("2024-01-15").cast("timestamp_ntz")).alias("late"))
    return late(v.ev.filter("code = 'click'")).unionByName(late(v.ev.filter("code2 = 'C5'")))


@query("op_G6_merge_rules", f"WITH {RULES_CTE} SELECT code, min(rule) AS rule FROM rules GROUP BY 1")
def _(v):
    return rules.catalog(v.spark, RULES).groupBy("code").agg(F.min("rule").alias("rule"))


@query("op_J3_rule_rows", sql("SELECT subject_id, name, CASE WHEN flag THEN 'met' ELSE 'indeterminate' END AS status FROM (SELECT subject_id, 'rich' AS name, balance > 5000 AS flag FROM subj UNION ALL SELECT subject_id, 'old', birth_year < 1950 FROM subj)"))
def _(v):
    flags = v.subj.select("subject_id", (F.col("balance") > 5000).alias("rich"), (F.col("birth_year") < 1950).alias("old"))
    return aggregate.unpivot_flags(flags, ["subject_id"], ["rich", "old"], "name", "flag").select("subject_id", "name", scalar.status(F.col("flag")).alias("status"))


@query("op_J4_user_groups", sql("""SELECT g AS "group", count(*) AS n FROM ev JOIN (VALUES ('purchase','money'), ('view','seen'), ('click','seen'), ('purchase','p_any'), ('signup','all_v'), ('view','all_v'), ('error','all_v')) t(c, g) ON code = c GROUP BY 1"""))
def _(v):
    return rules.split_groups(v.ev, GROUPS, code="code").groupBy("group").agg(F.count("*").alias("n"))


@query("op_J6_derive", sql("SELECT event_id FROM ev WHERE code IN ('view', 'purchase') AND value > 30"))
def _(v):
    derive = lambda df: df.filter(F.col("code").isin("view", "purchase") & (F.col("value") > 30))
    return v.ev.transform(derive).select("event_id")


# ---- K, L, S, I --------------------------------------------------------------------------------------


@query("op_K1_audit_by_unit", sql("SELECT unit, count(*) AS considered FROM ev WHERE code IN ('view', 'purchase') GROUP BY 1"))
def _(v):
    judged = rules.numeric_rule(v.ev, PRESSURE, code="code", value="raw_value", unit="unit")
    return rules.audit(judged, "unit").select("unit", "considered")


@query("op_K27_rule_counts", sql("SELECT r.rule, e.system, count(DISTINCT e.event_id) AS n FROM ev e JOIN rules r ON " + sql_rule_match() + " GROUP BY 1, 2", RULES_CTE))
def _(v):
    return rules.match_codes(v.ev, rules.catalog(v.spark, RULES), code="code2", system="system").groupBy("rule", "system").agg(F.count("*").alias("n"))


@query("op_L1_stage_reuse", "SELECT count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS ids FROM orders")
def _(v):
    from cairn.sources.manifests import identity, stage

    (orders,) = tables(v.spark, v.dir, "orders")
    path, key = scratch(v, "stage"), identity(table="orders")
    stage(v.spark, path, key, lambda: orders.select("o_orderkey"))

    def again():
        raise AssertionError("a finished stage is not built again")

    return stage(v.spark, path, key, again).agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("ids"))


@query("op_L2_join_multiplier", sql("SELECT (SELECT count(*) FROM enc) AS before, (SELECT count(*) FROM enc JOIN ev USING (subject_id)) AS after, (SELECT count(*) FROM enc JOIN ev USING (subject_id)) / CAST((SELECT count(*) FROM enc) AS DOUBLE) AS multiplier"))
def _(v):
    return joins.multiplier(v.enc, v.enc.select("subject_id").join(v.ev.select("subject_id"), "subject_id"))


@query("op_S1_append", "SELECT count(*) AS n FROM (SELECT * FROM region UNION ALL SELECT * FROM region)")
def _(v):
    from cairn.sources.writers import write_table

    (region,) = tables(v.spark, v.dir, "region")
    path = write_table(region, scratch(v, "append"))
    write_table(region, path, mode="append")
    return v.spark.read.parquet(path).agg(F.count("*").alias("n"))


@query("op_S8_unique_ids", "SELECT DISTINCT user_id FROM events")
def _(v):
    from cairn.sources.writers import unique_ids

    (e,) = tables(v.spark, v.dir, "events")
    return v.spark.read.parquet(unique_ids(e, "user_id", scratch(v, "ids")))


@query("op_I1_stream_windows", "SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY 1")
def _(v):
    import uuid

    from cairn.streaming.incremental import counts, run_once, source

    (e,) = tables(v.spark, v.dir, "events")
    stream = source(v.spark, f"{v.dir}/events.parquet*", e.schema).withColumn("day", temporal.iso_date(F.col("ts")))
    return run_once(counts(stream, ["day"], "ts"), f"cairn_{uuid.uuid4().hex}", mode="complete", checkpoint=scratch(v, "stream")).select("day", F.col("n_events").alias("n"))
