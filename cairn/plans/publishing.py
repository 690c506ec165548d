"""Queries over exports, stores, sinks and resumable work: what is written is read back and compared."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairn import shared
from cairn.functions import scalar, temporal
from cairn.operators import aggregate, cohort, reduce
from cairn.plans.registry import query
from cairn.plans.roles import sql, tables


def _export(v) -> str:
    """An export: nation in two numbered files, region in one, and files of the same stem further down."""
    from cairn.sources.writers import write_one_csv

    root = shared.fresh_path(v.spark, "export")
    nation, region = tables(v.spark, v.dir, "nation", "region")
    nation, region = nation.select("n_nationkey", "n_name"), region.select("r_regionkey", "r_name")
    write_one_csv(v.spark, nation.filter("n_nationkey % 2 = 0"), f"{root}/Nation0001.csv", ["n_nationkey"])
    write_one_csv(v.spark, nation.filter("n_nationkey % 2 = 1"), f"{root}/Nation0002.csv", ["n_nationkey"])
    write_one_csv(v.spark, region, f"{root}/Region.csv", ["r_regionkey"])
    write_one_csv(v.spark, nation.filter("n_nationkey > 20"), f"{root}/old/Nation.csv", ["n_nationkey"])
    return root


@query("op_A2_export_family", "SELECT CASE WHEN n_nationkey % 2 = 0 THEN 'Nation0001.csv' ELSE 'Nation0002.csv' END AS file, CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name FROM nation")
def _(v):
    from cairn.sources.readers import list_files, read_csv, select_family

    files = select_family(list_files(v.spark, _export(v)), "nation")
    return read_csv(v.spark, files, ["n_nationkey", "n_name"]).select(F.element_at(F.split("_file", "/"), -1).alias("file"), "n_nationkey", "n_name")


@query("op_A3_validate_export", "SELECT * FROM (VALUES ('Nation0001.csv', 2, 'n_comment'), ('Nation0002.csv', 2, 'n_comment'), ('Region.csv', 2, NULL), ('supplier', 0, 'no files')) t(what, columns, missing)")
def _(v):
    from cairn.sources.readers import validate_export

    report = validate_export(v.spark, _export(v), {"nation": ["n_nationkey", "n_comment"], "region": ["r_name"], "supplier": ["s_suppkey"]})
    lost = {e.rsplit("/", 1)[-1].split(": missing ")[0]: e.split(": missing ")[1] for e in report.errors if ": missing " in e}
    rows = [(p.rsplit("/", 1)[-1], len(names), lost.get(p.rsplit("/", 1)[-1])) for p, names in report.columns.items()]
    rows += [(e.removeprefix("no files for "), 0, "no files") for e in report.errors if e.startswith("no files")]
    return v.spark.createDataFrame(rows, "what string, columns int, missing string")


@query("op_A5_many_csv", "SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name FROM nation UNION ALL SELECT CAST(n_nationkey AS VARCHAR), n_name FROM nation WHERE n_nationkey > 20")
def _(v):
    from cairn.sources.readers import list_files, read_csv

    files = [f for f in list_files(v.spark, _export(v)) if "/Nation" in f]
    return read_csv(v.spark, files, ["n_nationkey", "n_name"]).select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))


@query("op_A12_attached_product", "SELECT n_name, count(*) AS customers FROM nation JOIN customer ON n_nationkey = c_nationkey GROUP BY 1")
def _(v):
    from cairn.sources.manifests import write_manifest
    from cairn.sources.readers import open_product

    customer, nation = tables(v.spark, v.dir, "customer", "nation")
    path = shared.fresh_path(v.spark, "attached")
    nation.write.parquet(f"{path}/nation")
    write_manifest(v.spark, path, {"nation": nation})
    other = open_product(v.spark, path)  # another product's tables, read beside our own and never written
    return customer.join(other["nation"], F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name").agg(F.count("*").alias("customers"))


@query("op_A15_checksummed_read", "SELECT n_nationkey, n_name FROM nation")
def _(v):
    from cairn.sources.readers import checksums, read_checked

    (nation,) = tables(v.spark, v.dir, "nation")
    path = shared.fresh_path(v.spark, "checked")
    nation.select("n_nationkey", "n_name").write.parquet(path)
    return read_checked(v.spark, path, checksums(v.spark, path))


@query("op_S5_preheaded_csv", "SELECT 'full' AS output, CAST(n_nationkey AS VARCHAR) AS id, n_name AS name FROM nation UNION ALL SELECT 'full', CAST(r_regionkey AS VARCHAR), r_name FROM region UNION ALL SELECT 'columns', 'empty', 'id,name'")
def _(v):
    from cairn.sources.readers import header, list_files, read_csv
    from cairn.sources.writers import append_rows, pre_head

    nation, region = tables(v.spark, v.dir, "nation", "region")
    root = shared.fresh_path(v.spark, "outputs")
    pre_head(v.spark, root, {"full": ["id", "name"], "empty": ["id", "name"]})
    append_rows(nation.select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("id")), f"{root}/full", ["id", "name"])
    append_rows(region.select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name")), f"{root}/full", ["id", "name"])
    rows = read_csv(v.spark, list_files(v.spark, f"{root}/full")).select(F.lit("full").alias("output"), "id", "name")
    (empty,) = list_files(v.spark, f"{root}/empty")
    return rows.unionByName(v.spark.createDataFrame([("columns", "empty", ",".join(header(v.spark, empty)))], "output string, id string, name string"))


@query("op_S9_partitioned_store", "SELECT c_custkey, c_name FROM customer WHERE c_custkey % 7 = 3 UNION ALL SELECT c_custkey, c_name FROM customer WHERE c_custkey % 7 = 3 AND c_custkey % 2 = 0")
def _(v):
    from cairn.sources.writers import PartitionStore

    customer = tables(v.spark, v.dir, "customer")[0].select("c_custkey", "c_name")
    store = PartitionStore(v.spark, shared.fresh_path(v.spark, "store"), "c_custkey", 8)
    store.add(customer)
    store.add(customer.filter("c_custkey % 2 = 0"))
    store.seal()
    return store.rows_of(customer.filter("c_custkey % 7 = 3").select("c_custkey"))


@query("op_E6_nearest_height", sql("""SELECT weight_id, height_id, gap_seconds FROM (SELECT w.event_id AS weight_id, h.event_id AS height_id, abs(date_diff('second', w.ts, h.ts)) AS gap_seconds,
   row_number() OVER (PARTITION BY w.event_id ORDER BY abs(date_diff('second', w.ts, h.ts)), h.event_id) AS r FROM ev w JOIN ev h ON w.subject_id = h.subject_id AND abs(date_diff('second', w.ts, h.ts)) <= 72 * 3600 WHERE w.code = 'view' AND h.code = 'click') WHERE r = 1"""))
def _(v):
    weight = v.ev.filter("code = 'view'").select("subject_id", F.col("event_id").alias("weight_id"), F.col("ts").alias("weight_ts"))
    height = v.ev.filter("code = 'click'").select("subject_id", F.col("event_id").alias("height_id"), F.col("ts").alias("height_ts"))
    return cohort.pair_measures(weight, height, ["subject_id"], left_id="weight_id", left_ts="weight_ts", right_ts="height_ts", hours=72, tie="height_id").select("weight_id", "height_id", "gap_seconds")


@query("op_F6_sorted_files", sql("SELECT event_id, subject_id, CAST(row_number() OVER (ORDER BY value DESC, event_id) AS BIGINT) AS place FROM ev"))
def _(v):
    from cairn.operators.order import row_order

    path = shared.fresh_path(v.spark, "sorted")
    v.ev.select("event_id", "subject_id", (-F.col("value")).alias("key")).orderBy("key", "event_id").write.parquet(path)  # a range of the order in each file
    return row_order(v.spark, v.spark.read.parquet(path), ["key", "event_id"], "place").select("event_id", "subject_id", "place")


@query("op_F7_rebatched", "SELECT count(*) AS rows, true AS bounded FROM orders")
def _(v):
    from cairn.sources.writers import write_batches

    (orders,) = tables(v.spark, v.dir, "orders")
    path = write_batches(orders.select("o_orderkey").repartition(40), shared.fresh_path(v.spark, "batches"), 200)
    sizes = v.spark.read.parquet(path).groupBy(F.col("_metadata.file_path")).agg(F.count("*").alias("n"))
    return sizes.agg(F.sum("n").alias("rows"), F.max(F.col("n") <= 200).alias("bounded"))


@query("op_G7_id_intersect", sql("SELECT subject_id FROM ev WHERE code = 'view' INTERSECT SELECT subject_id FROM ev WHERE code = 'purchase' INTERSECT SELECT subject_id FROM subj WHERE sex = 'F'"))
def _(v):
    ids = lambda df: df.select("subject_id")
    return ids(v.ev.filter("code = 'view'")).intersect(ids(v.ev.filter("code = 'purchase'"))).intersect(ids(v.subj.filter("sex = 'F'")))


@query("op_H_divisor", sql("SELECT event_id, round(CASE WHEN code2 = 'V12' THEN value / 9.008 ELSE value END, 8) AS value FROM ev"))
def _(v):
    return v.ev.select("event_id", F.round(scalar.divided_by_code(F.col("value"), F.col("code2"), {"V12": scalar.LACTATE_DIVISOR}), 8).alias("value"))


@query("op_I5_stream_resume", "SELECT user_id AS id, count(*) AS n FROM events GROUP BY 1")
def _(v):
    from cairn.streaming.incremental import run_to, source

    (e,) = tables(v.spark, v.dir, "events")
    root = shared.fresh_path(v.spark, "resume")
    half = F.pmod(F.col("event_id"), F.lit(2))
    for turn in (0, 1):  # new files arrive between two runs; the second run takes only them, and a third nothing
        e.filter(half == turn).select("event_id", "user_id").write.mode("append").parquet(f"{root}/in")
        run_to(source(v.spark, f"{root}/in", e.select("event_id", "user_id").schema), f"{root}/out", f"{root}/checkpoint")
    run_to(source(v.spark, f"{root}/in", e.select("event_id", "user_id").schema), f"{root}/out", f"{root}/checkpoint")
    return v.spark.read.parquet(f"{root}/out").groupBy(F.col("user_id").alias("id")).agg(F.count("*").alias("n"))


@query("op_I6_build_progress", "SELECT * FROM (VALUES ('one', 'done', (SELECT count(*) FROM nation)), ('two', 'done', (SELECT count(*) FROM region)), ('three', 'waiting', NULL)) t(stage, state, rows)")
def _(v):
    from cairn.sources.manifests import identity, progress, stage

    nation, region = tables(v.spark, v.dir, "nation", "region")
    root = shared.fresh_path(v.spark, "build")
    stage(v.spark, f"{root}/one", identity(stage="one"), lambda: nation)
    stage(v.spark, f"{root}/two", identity(stage="two"), lambda: region)
    return progress(v.spark, root, ["one", "two", "three"])


@query("op_J2_temporal_fragments", sql("""SELECT event_id, ts >= date_trunc('day', TIMESTAMP '2024-01-20 13:30:30' - INTERVAL 10 DAY) AND ts <= TIMESTAMP '2024-01-20 13:30:30' AS before, ts > TIMESTAMP '2024-01-05 13:30:30' AND ts <= TIMESTAMP '2024-01-05 13:30:30' + INTERVAL 10 DAY AS after FROM ev"""))
def _(v):
    index, other = F.lit("2024-01-20 13:30:30").cast("timestamp_ntz"), F.lit("2024-01-05 13:30:30").cast("timestamp_ntz")
    before = (F.col("ts") >= temporal.day(index - F.expr("INTERVAL '10' DAY"))) & (F.col("ts") <= index)
    after = (F.col("ts") > other) & (F.col("ts") <= other + F.expr("INTERVAL '10' DAY"))
    return v.ev.select("event_id", before.alias("before"), after.alias("after"))


@query("op_J5_priority_aggregate", sql("SELECT encounter_id, first(unit ORDER BY CASE unit WHEN 'kPa' THEN 2 WHEN 'mg' THEN 1 ELSE 0 END DESC, event_id) AS unit FROM ev GROUP BY 1"))
def _(v):
    return v.ev.groupBy("encounter_id").agg(reduce.by_priority("unit", {"kPa": 2, "mg": 1}, "event_id").alias("unit"))


@query("op_J7_dictionary_map", sql("SELECT event_id, CASE code WHEN 'view' THEN 'seen' WHEN 'click' THEN 'touched' ELSE code END AS code FROM ev"))
def _(v):
    return v.ev.select("event_id", scalar.recode(F.col("code"), {"view": "seen", "click": "touched"}).alias("code"))


@query("op_L3_input_inspection", sql("SELECT code, count(*) AS rows, count(*) FILTER (WHERE unit IS NULL) AS without_unit, min(event_id) AS first_match, max(event_id) AS last_match FROM ev GROUP BY 1"))
def _(v):
    return v.ev.groupBy("code").agg(F.count("*").alias("rows"), F.count_if(F.col("unit").isNull()).alias("without_unit"), F.min("event_id").alias("first_match"), F.max("event_id").alias("last_match"))


@query("op_L4_resumed_build", "SELECT r_name, count(*) AS nations FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def _(v):
    from cairn.sources.manifests import build

    nation, region = tables(v.spark, v.dir, "nation", "region")
    root, runs = shared.fresh_path(v.spark, "phases"), []

    def joined(done):
        return done["nation"].join(done["region"], F.col("n_regionkey") == F.col("r_regionkey"))

    def broken(done):
        runs.append(1)
        if len(runs) == 1:
            raise RuntimeError("the first run ends here")
        return joined(done).groupBy("r_name").agg(F.count("*").alias("nations"))

    phases = {"nation": lambda done: nation, "region": lambda done: region, "counts": broken}
    try:
        build(v.spark, root, phases, inputs="v1")
    except RuntimeError:
        pass
    phases |= {n: lambda done: (_ for _ in ()).throw(AssertionError("built twice")) for n in ("nation", "region")}
    return build(v.spark, root, phases, inputs="v1")["counts"]


@query("op_L5_crash_recovery", "SELECT 'finished' AS run, n_name AS name FROM nation WHERE n_nationkey >= 10 UNION ALL SELECT 'undone', n_name FROM nation WHERE n_nationkey < 10")
def _(v):
    from cairn.sources.writers import publish, recover

    (nation,) = tables(v.spark, v.dir, "nation")
    out = None
    for run, crash in (("finished", "moved"), ("undone", "staged")):  # after the old copy has gone aside; before anything moved
        root = shared.fresh_path(v.spark, "publish")
        nation.filter("n_nationkey < 10").write.parquet(f"{root}/next")
        publish(v.spark, f"{root}/next", f"{root}/table")
        nation.filter("n_nationkey >= 10").write.parquet(f"{root}/next")
        try:
            publish(v.spark, f"{root}/next", f"{root}/table", fail_after=crash)
        except InterruptedError:
            pass
        recover(v.spark, f"{root}/table", finish=run == "finished")
        part = v.spark.read.parquet(f"{root}/table").select(F.lit(run).alias("run"), F.col("n_name").alias("name"))
        out = part if out is None else out.unionByName(part)
    return out


@query("op_L7_output_location", "SELECT true AS refused, true AS allowed")
def _(v):
    import os
    import tempfile

    from cairn.sources.readers import SourceError
    from cairn.sources.writers import refuse_inside_worktree

    root = tempfile.mkdtemp(prefix="cairn-worktree-")
    os.makedirs(f"{root}/repo/.git")

    def refused(path):
        try:
            return refuse_inside_worktree(path) is None
        except SourceError:
            return True

    return v.spark.createDataFrame([(refused(f"file://{root}/repo/data/out"), not refused(f"file://{root}/elsewhere/out"))], "refused boolean, allowed boolean")


@query("op_L9_hash_manifests", sql("SELECT 'subjects' AS name, count(*) AS rows, 'same' AS outcome FROM subj UNION ALL SELECT 'encounters', count(*), 'changed' FROM enc"))
def _(v):
    from cairn.sources.manifests import compare_manifests, read_manifest, write_manifest

    enc = v.enc.select("encounter_id", "subject_id", "type")
    subj = v.subj.select("subject_id", "sex", "region")
    paths = [shared.fresh_path(v.spark, "manifest") for _ in range(2)]
    write_manifest(v.spark, paths[0], {"subjects": subj, "encounters": enc})
    write_manifest(v.spark, paths[1], {"subjects": subj.repartition(5), "encounters": enc.withColumn("type", F.lower("type"))})  # order and partitions don't matter, content does
    left, right = (read_manifest(v.spark, p) for p in paths)
    found = compare_manifests(left, right)
    rows = [(n, left["tables"][n]["rows"], "changed" if n in found["digest"] else "same") for n in left["tables"]]
    return v.spark.createDataFrame(rows, "name string, rows long, outcome string")


@query("op_L10_parity", sql("SELECT count(*) AS rows, count(*) AS equal, CAST(0 AS BIGINT) AS missing, CAST(0 AS BIGINT) AS extra FROM (SELECT subject_id, code, count(*) FROM ev GROUP BY 1, 2)"))
def _(v):
    from cairn.sources.manifests import parity

    one = v.ev.groupBy("subject_id", "code").agg(F.count("*").alias("n"))
    two = aggregate.observability(v.ev, ["subject_id", "code"], "ts").select("subject_id", "code", F.col("n_events").alias("n"))
    return parity(one, two, ["subject_id", "code"])
