"""Bounded counters, cells, lookups, filters, guards, ranks, capture and digest trees against plain Python, with hot keys."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cairn import shared
from cairn.operators import aggregate, cohort, frequent, guards, joins, membership, order
from cairn.operators.reduce import asc, desc
from cairn.sources.digests import DigestTree
from cairn.sources.lookup import KeyLookup

EPOCH = dt.datetime(2024, 1, 1)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# ---- D19 ------------------------------------------------------------------------------------------


@pytest.mark.parametrize("tasks, capacity, fan", [(1, 20, 16), (7, 20, 2), (40, 10, 4), (5, 1000, 16)])
def test_heavy_hitters_keep_their_bounds(spark, tasks, capacity, fan):
    rng = random.Random(tasks)
    rows = [(rng.choice("ab"), None if rng.random() < 0.05 else int(rng.paretovariate(0.9))) for _ in range(6000)]
    rows += [("a", -1)] * 700
    df = spark.createDataFrame(rows, "d string, k long").repartition(tasks)
    for by in ([], ["d"]):
        true = Counter(rows)
        found = frequent.heavy_hitters(df, ["d", "k"], capacity, by=by, capacity=capacity, fan=fan).collect()
        assert all(r["n"] - r["error"] <= true[r["d"], r["k"]] <= r["n"] for r in found)
        groups = {d: [(key, n) for key, n in true.items() if d in (None, key[0])] for d in (["a", "b"] if by else [None])}
        for some in groups.values():
            total = sum(n for _, n in some)
            assert {key for key, n in some if n > total / capacity} <= {(r["d"], r["k"]) for r in found}
        assert len(found) <= capacity * len(groups)
        if capacity == 1000:  # few keys: exact
            assert {(r["d"], r["k"]): (r["n"], r["error"]) for r in found} == {key: (n, 0) for key, n in true.items()}


def test_heavy_hitters_of_the_classic_cases(spark):
    """Two files of 2,002 single codes and a target among them, then the target alone: its bounds hold; and nothing gives nothing."""
    first = spark.createDataFrame([(f"CODE_{i:04d}",) for i in range(2002)] + [("TARGET",)], "code string").coalesce(1)
    df = first.unionByName(spark.createDataFrame([("TARGET",)] * 100, "code string").coalesce(1))
    target = {r["code"]: r for r in frequent.heavy_hitters(df, ["code"], 100).collect()}["TARGET"]
    assert target["n"] - target["error"] <= 101 <= target["n"]
    assert frequent.heavy_hitters(df.limit(0), ["code"], 5).count() == 0
    weighted = spark.createDataFrame([(c,) for c, n in (("A", 5), ("B", 4), ("C", 6), ("D", 2)) for _ in range(n)], "code string").repartition(3)
    for r in frequent.heavy_hitters(weighted, ["code"], 2, capacity=2).collect():
        assert r["n"] - r["error"] <= {"A": 5, "B": 4, "C": 6, "D": 2}[r["code"]] <= r["n"]


# ---- D13, E9 --------------------------------------------------------------------------------------


def test_distinct_counts_of_a_hot_key(spark):
    rows = [("hot" if i % 10 else "cold", i % 3000) for i in range(9000)] + [("hot", None)]
    got = aggregate.distinct_by_shards(spark.createDataFrame(rows, "k string, v int"), ["k"], F.col("v"), "n", shards=16)
    assert dict(got.collect()) == {k: len({v for q, v in rows if q == k and v is not None}) for k in ("hot", "cold")}
    exchanges = [line for line in plan(got).splitlines() if "hashpartitioning" in line]
    assert any("_shard" in line and "_v" in line for line in exchanges)


def test_ranks_of_a_hot_key(spark):
    rng = random.Random(3)
    rows = [(None if i % 50 == 0 else 1 if i % 3 == 0 else i % 40, rng.randrange(200), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, v int, id int").repartition(5)
    got = {r["id"]: r["rank"] for r in order.ranked_in_ranges(df, ["k"], [desc("v"), asc("id")]).collect()}
    want = {}
    for k in {r[0] for r in rows}:
        for place, r in enumerate(sorted((r for r in rows if r[0] == k), key=lambda r: (-r[1], r[2])), 1):
            want[r[2]] = place
    assert got == want


def test_no_task_ranks_a_hot_key_alone(spark):
    df = spark.range(8000).select(F.lit(1).alias("k"), "id")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = order.ranked_in_ranges(df, ["k"], [asc("id")]).groupBy(F.spark_partition_id()).count().collect()
        text = plan(order.ranked_in_ranges(df, ["k"], [asc("id")]))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert "hashpartitioning(k" in text and "_range" in text[text.index("hashpartitioning(k") :][:60]
    assert len(sizes) >= 2 and max(r["count"] for r in sizes) < 8000


# ---- C15..C19 -------------------------------------------------------------------------------------


def spans(n, seed):
    rng = random.Random(seed)
    subject = lambda i: 1 if i % 3 == 0 else i % 20  # noqa: E731  one subject holds a third
    start = lambda: EPOCH + dt.timedelta(minutes=rng.randrange(60 * 24 * 40))
    left = [(i, subject(i), s, s + dt.timedelta(minutes=rng.choice([0, 30, 1440, 14400]))) for i in range(n) for s in [start()]]
    left += [(n, 1, None, EPOCH), (n + 1, 1, EPOCH, None), (n + 2, None, EPOCH, EPOCH), (n + 3, 1, EPOCH + dt.timedelta(3), EPOCH)]
    right = [(i, subject(i), start() if i % 17 else None) for i in range(3 * n)] + [(3 * n, None, EPOCH)]
    return left, right


@pytest.mark.parametrize("cell", [None, 3600, 86_400 * 30])
def test_interval_join_by_cells(spark, cell):
    left, right = spans(200, 5)
    a, b = spark.createDataFrame(left, "id int, k int, a timestamp_ntz, z timestamp_ntz"), spark.createDataFrame(right, "rid int, k int, ts timestamp_ntz")
    out = joins.within_cells(a, b, ["k"], start=F.col("a"), stop=F.col("z"), ts="ts", test=F.col("ts").between(F.col("a"), F.col("z")), cell=cell)
    want = [(i, r) for i, k, s, e in left for r, q, t in right if k is not None and k == q and s and e and t and s <= t <= e]
    assert len(want) > 100 and sorted((r["id"], r["rid"]) for r in out.collect()) == sorted(want)


def test_a_hot_subject_is_many_groups(spark):
    left, right = spans(400, 6)
    a, b = spark.createDataFrame(left, "id int, k int, a timestamp_ntz, z timestamp_ntz"), spark.createDataFrame(right, "rid int, k int, ts timestamp_ntz")
    for setting, value in (("spark.sql.adaptive.enabled", "false"), ("spark.sql.autoBroadcastJoinThreshold", "-1")):
        spark.conf.set(setting, value)
    try:
        text = plan(joins.within_cells(a, b, ["k"], start=F.col("a"), stop=F.col("z"), ts="ts", test=F.col("ts").between(F.col("a"), F.col("z")), cell=86_400))
    finally:
        for setting in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold"):
            spark.conf.unset(setting)
    exchanges = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 2 and all("_cell" in line for line in exchanges)


def test_as_of_forward_makes_no_pairs(spark):
    left, right = spans(100, 7)
    a, b = spark.createDataFrame([r[:3] for r in left], "id int, k int, ts timestamp_ntz"), spark.createDataFrame(right, "rid int, k int, at timestamp_ntz")
    out = joins.as_of_forward(a, b, ["k"], left_ts="ts", right_ts="at", first_days=1, last_days=4, values=["rid"], tie="rid")
    assert "Join" not in plan(out)
    got = sorted((r["id"], r["rid"]) for r in out.collect())
    day = dt.timedelta(1)
    want = [(i, min(((t, r) for r, q, t in right if k is not None and q == k and s and t and s + day <= t <= s + 4 * day), default=(None, None))[1]) for i, k, s, _ in left]
    assert got == sorted(want)


# ---- C24, C25 -------------------------------------------------------------------------------------


def test_lookup_needs_no_exchange(spark):
    stored = spark.createDataFrame([(i, f"v{i}") for i in range(500)] + [(None, "none")], "k int, v string")
    asked = spark.createDataFrame([(i % 700, i) for i in range(900)] + [(None, -1)], "k int, id int")
    one, two = KeyLookup.write(stored, "k", ["v"], buckets=8, unique=True), KeyLookup.write(asked, "k", ["id"], buckets=8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = one.joined(two)
        assert "Exchange" not in plan(out) and "Join" in plan(out)
        assert sorted((r["id"], r["v"]) for r in out.collect()) == sorted((i, f"v{i % 700}") for i in range(900) if i % 700 < 500)
        assert sorted(r["k"] for r in one.rows_for(asked).collect()) == list(range(500))
        assert one.matching(asked).count() == sum(i % 700 < 500 for i in range(900))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    repeated = KeyLookup.write(stored.unionByName(stored.limit(1)), "k", ["v"], buckets=8, unique=True)
    with pytest.raises(Exception, match="lookup of k: key .* is not unique"):
        repeated.rows_for(asked).collect()
    for store in (one, two, repeated):
        store.drop()


def test_hash_filter_loses_nothing_and_has_a_fixed_size(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 7 != 0, F.col("id")).alias("k"))
    members = spark.createDataFrame([(i * 3,) for i in range(1000)] + [(None,)], "k long")
    small = membership.HashFilter.of(members, "k", bits=2048)
    assert small.words.count() <= 2048 // 64 and membership.HashFilter.of(spark.range(20_000).withColumnRenamed("id", "k"), "k", bits=2048).words.count() <= 2048 // 64
    want = {i for i in range(5000) if i % 7 and i % 3 == 0 and i < 3000}
    assert {r["k"] for r in membership.semi(df, members, "k", small).collect()} == want
    rows, retained, kept, over = membership.retention(df, members, "k", small).first()
    assert rows == 5000 and kept == len(want) and retained == kept + over and over > 0
    assert membership.retention(df, members, "k", membership.HashFilter.of(members, "k")).first()["over"] < 20
    assert membership.semi(df, members.limit(0), "k").count() == 0


# ---- L2 -------------------------------------------------------------------------------------------


def jobs(spark) -> int:
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup("guards"))


def test_guards_are_part_of_the_plan(spark):
    left, right = spark.createDataFrame([(1,), (None,)], "k int"), spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    spark.sparkContext.setJobGroup("guards", "guards")
    try:
        guarded = joins.guarded_left(left, right, ["k"]).select("k")
        nulls = joins.guarded_left(left, right.limit(1), ["k"], require_keys=True)
        assert jobs(spark) == 0  # building starts nothing
        with pytest.raises(Exception, match=r"right side: key \(1, \) is not unique"):
            guarded.collect()
        with pytest.raises(Exception, match="left side: null in"):
            nulls.collect()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    fine = joins.guarded_left(left, right.filter("v = 'a'"), ["k"]).collect()
    assert sorted(map(tuple, fine), key=str) == [(1, "a"), (None, None)]


def test_watched_steps_report_their_multiplier(spark):
    watched = guards.Watched("double")
    out = watched.after(watched.before(spark.range(100)).withColumn("x", F.explode(F.array(F.lit(1), F.lit(2)))), F.sum("x").alias("total"))
    out.write.format("noop").mode("overwrite").save()
    assert watched.multiplier() == 2.0 and watched.metrics()["after"]["total"] == 300
    watched.check(2.0)
    with pytest.raises(guards.GuardError, match="double: 2.0000 rows for each row"):
        watched.check(1.5)


# ---- K28, L10 -------------------------------------------------------------------------------------


def test_capture_scans_once(spark, tmp_path):
    path = f"file://{tmp_path}/events"
    spark.createDataFrame([(1, 7, "A1", "S", EPOCH), (2, 7, "B2", "s", EPOCH), (3, 8, None, "S", None), (1, 7, "A1", "S", EPOCH)], "id int, p int, c string, s string, ts timestamp_ntz").write.parquet(path)
    catalog = [("a", "d", "ANY", "A", "prefix", True), ("a", "d", "S", "A1", "exact", True), ("b", "d", "S", "^B", "regex", True), ("off", "d", "ANY", "A1", "exact", False)]
    out = cohort.capture(spark.read.parquet(path), catalog, shared.fresh_path(spark, "capture"), key="id", subject="p", code="c", system="s", ts="ts")
    assert sorted((r["id"], r["rule"]) for r in out["membership"].collect()) == [(1, "a"), (1, "a"), (2, "b")]
    assert sorted(r["id"] for r in out["source"].collect()) == [1, 1, 2]
    assert sorted((r["p"], str(r["day"]), r["n"]) for r in out["observability"].collect()) == [(7, "2024-01-01", 1)] * 3 + [(8, "None", 1)]


def test_digest_tree_opens_only_what_differs(spark):
    rows = spark.range(40_000).select("id", (F.col("id") % 7).alias("v"), F.when(F.col("id") % 5 == 0, None).otherwise(F.col("id").cast("string")).alias("s"))
    other = rows.filter("id <> 11").withColumn("v", F.when(F.col("id").isin(5, 777), F.lit(None)).otherwise(F.col("v"))).unionByName(rows.filter("id = 900"))
    one, two, same = (DigestTree.write(df, ["id"], shared.fresh_path(spark, "tree"), page_rows=50) for df in (rows, other.repartition(3), rows.repartition(7)))
    assert one.root().first() == same.root().first() != two.root().first() and one.changed(same).count() == 0
    found = sorted(((r["side"], r["id"], r["v"], r["n"]) for r in one.changed(two).collect()), key=str)
    assert found == sorted([("left", 5, 5, 1), ("left", 777, 0, 1), ("left", 11, 4, 1), ("right", 5, None, 1), ("right", 777, None, 1), ("right", 900, 4, 1)], key=str)
    read = one.rows_of(one.differing(two))
    read.write.format("noop").mode("overwrite").save()
    opened = read.select("*")
    execution = opened._jdf.queryExecution().executedPlan()
    opened._jdf.queryExecution().toRdd().count()
    scan = execution
    while scan.children().size():
        scan = scan.children().head()
    assert scan.metrics().apply("numOutputRows").value() < 40_000 / 100


# ---- I1, I2, I3 -----------------------------------------------------------------------------------


def test_streams_keep_state_between_runs(spark):
    from cairn.streaming import incremental

    rng = random.Random(9)
    rows = [(i % 40 if i % 3 else 1, EPOCH + dt.timedelta(minutes=rng.randrange(5000)), i) for i in range(600)]
    schema, root = "k long, ts timestamp_ntz, id long", shared.fresh_path(spark, "stream")
    for turn in range(3):
        spark.createDataFrame(rows[200 * turn : 200 * (turn + 1)], schema).repartition(2).write.mode("append").parquet(f"{root}/in")
        stream = incremental.source(spark, f"{root}/in", spark.createDataFrame([], schema).schema, files_per_batch=1)
        incremental.run_to(incremental.keep_first(stream, "k", ["ts", "id"], ["k", "ts", "id"]), f"{root}/first", f"{root}/c1")
        incremental.run_to(incremental.members(stream, ["k"]), f"{root}/members", f"{root}/c2")
        seen = rows[: 200 * (turn + 1)]
        got = spark.read.parquet(f"{root}/first").groupBy("k").agg(F.min_by("id", F.struct("ts", "id")).alias("id"), F.count("*").alias("n"))
        assert {r["k"]: r["id"] for r in got.collect()} == {k: min((t, i) for q, t, i in seen if q == k)[1] for k in {r[0] for r in seen}}
        assert sorted(r["k"] for r in spark.read.parquet(f"{root}/members").collect()) == sorted({r[0] for r in seen})
    assert spark.read.parquet(f"{root}/first").count() < len(rows) / 2  # updates only
