"""Stores, publication, checksums and resumed builds, in their failing cases too; joins and quartiles against plain Python."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from cairn import shared
from cairn.operators import aggregate, cohort, joins, rules
from cairn.sources.manifests import build, parity, progress
from cairn.sources.readers import SourceError, checksums, read_checked
from cairn.sources.writers import PartitionStore, publish, recover

T0 = dt.datetime(2024, 1, 1)


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "id long")


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_a_sealed_store_takes_no_more(spark):
    store = PartitionStore(spark, shared.fresh_path(spark, "t"), "id", 4)
    store.add(numbers(spark, 1, 2, 3))
    with pytest.raises(SourceError):
        store.read()
    store.add(numbers(spark, 3, None))
    store.seal()
    for again in (lambda: store.add(numbers(spark, 9)), store.seal):
        with pytest.raises(SourceError):
            again()
    assert ids(store.rows_of(numbers(spark, 3, 77))) == [3, 3] and store.read().count() == 5


@pytest.mark.parametrize("crash", ["staged", "moved", "placed"])
@pytest.mark.parametrize("finish", [True, False])
def test_publication_survives_a_crash_at_each_step(spark, crash, finish):
    root = shared.fresh_path(spark, "t")
    numbers(spark, 1).write.parquet(f"{root}/next")
    publish(spark, f"{root}/next", f"{root}/table")
    numbers(spark, 2).write.parquet(f"{root}/next")
    with pytest.raises(InterruptedError):
        publish(spark, f"{root}/next", f"{root}/table", fail_after=crash)
    assert recover(spark, f"{root}/table", finish=finish) and not recover(spark, f"{root}/table")
    assert ids(spark.read.parquet(f"{root}/table")) == ([2] if finish or crash == "placed" else [1])
    if not finish and crash != "placed":
        publish(spark, f"{root}/next", f"{root}/table")  # the staged copy is still there
        assert ids(spark.read.parquet(f"{root}/table")) == [2]


def test_an_unfinished_publication_is_finished_by_the_next(spark):
    root = shared.fresh_path(spark, "t")
    for n in (1, 2, 3):
        numbers(spark, n).write.parquet(f"{root}/next{n}")
    publish(spark, f"{root}/next1", f"{root}/table")
    with pytest.raises(InterruptedError):
        publish(spark, f"{root}/next2", f"{root}/table", fail_after="moved")
    publish(spark, f"{root}/next3", f"{root}/table")
    assert ids(spark.read.parquet(f"{root}/table")) == [3]


def test_changed_files_are_refused(spark):
    path = shared.fresh_path(spark, "t")
    numbers(spark, 1, 2).write.parquet(path)
    found = checksums(spark, path)
    expected = spark.createDataFrame(found.collect(), found.schema)  # as a manifest keeps them
    assert ids(read_checked(spark, path, expected)) == [1, 2]
    numbers(spark, 3).write.mode("append").parquet(path)
    with pytest.raises(SourceError):
        read_checked(spark, path, expected)


def test_a_build_takes_up_after_its_last_phase(spark):
    root, ran = shared.fresh_path(spark, "t"), []
    phases = {"a": lambda done: ran.append("a") or numbers(spark, 1), "b": lambda done: ran.append("b") or done["a"]}
    assert progress(spark, root, list(phases)).filter("state = 'waiting'").count() == 2
    build(spark, root, phases, inputs=1)
    assert ids(build(spark, root, phases, inputs=1)["b"]) == [1] and ran == ["a", "b"]
    with pytest.raises(SourceError):
        build(spark, root, phases, inputs=2)


def test_parity_counts_what_differs(spark):
    one = spark.createDataFrame([(1, 1), (2, 2), (None, 3), (4, None)], "k int, v int")
    two = spark.createDataFrame([(1, 1), (2, 5), (None, 3), (6, 6), (4, None)], "k int, v int")
    assert tuple(parity(one, two, ["k"]).first()) == (4, 3, 0, 1)


def test_quartiles_equal_plain_python(spark):
    rng = random.Random(2)
    groups = {"one": [7.5], "two": [1.0, -3.0], "equal": [0.0] * 9 + [-0.0], "tiny": [5e-324, 1e-308, -1e-310, 0.0], "mixed": [rng.gauss(0, 10 ** rng.randrange(-3, 5)) for _ in range(701)], "dense": [1 + rng.random() / 1e6 for _ in range(400)]}
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("one", None), ("none", None)]
    got = {r["g"]: (r["q1"], r["q2"], r["q3"]) for r in aggregate.quartiles(spark.createDataFrame(rows, "g string, v double"), "v", "g").collect()}
    assert set(got) == set(groups)
    for g, vs in groups.items():
        vs = sorted(vs)
        want = []
        for p in (0.25, 0.5, 0.75):
            at = (len(vs) - 1) * p
            low = int(at)
            want.append(vs[low] + (vs[min(low + 1, len(vs) - 1)] - vs[low]) * (at - low))
        assert got[g] == pytest.approx(want, rel=1e-12, abs=0)
    assert statistics.median(groups["mixed"]) == pytest.approx(got["mixed"][1])
    whole = aggregate.quartiles(spark.createDataFrame(rows, "g string, v double"), "v").first()
    assert whole["q2"] == pytest.approx(statistics.median(v for vs in groups.values() for v in vs))


def test_levels_pair_as_all_pairs_do(spark):
    rng = random.Random(4)
    stamp = lambda: T0 + dt.timedelta(seconds=rng.randrange(5 * 86400))
    left = spark.createDataFrame([(i, rng.randrange(3), stamp(), rng.choice([None, 1, 2])) for i in range(60)], "a long, s int, t timestamp_ntz, e int")
    right = spark.createDataFrame([(i, rng.randrange(3), stamp(), rng.choice([None, 1, 2])) for i in range(80)], "b long, s int, u timestamp_ntz, f int")
    near = F.abs(F.unix_seconds(F.col("t").cast("timestamp")) - F.unix_seconds(F.col("u").cast("timestamp")))
    day, other = F.to_date("t"), F.to_date("u")
    order = [near.asc(), F.col("b").asc()]
    plain = joins.pair_nearest(left, right, ["s"], left_id="a", order=order, ranks=[F.col("e") == F.col("f"), near <= 1800, day == other])
    levels = [(F.col("e"), F.col("f"), F.lit(True)), (F.array(F.date_sub(day, 1), day, F.date_add(day, 1)), other, near <= 1800), (day, other, F.lit(True))]
    fast = joins.pair_by_levels(left, right, ["s"], left_id="a", order=order, levels=levels)
    pick = lambda df: sorted(tuple(r) for r in df.select("a", "b", "level").collect())
    assert pick(plain) == pick(fast) and len(pick(fast)) > 40


def test_the_nearest_measure_of_the_best_rank(spark):
    rng = random.Random(6)
    at = lambda: T0 + dt.timedelta(milliseconds=rng.randrange(40_000))
    index = [(i, rng.randrange(5), at()) for i in range(50)]
    measures = [(i, rng.randrange(4), at() if i % 9 else None, rng.choice([1, 2])) for i in range(60)]
    out = cohort.choose_measure(spark.createDataFrame(index, "i long, s int, t timestamp_ntz"), spark.createDataFrame(measures, "m long, s int, u timestamp_ntz, r int"), ["s"], index_id="i", index_ts="t", ts="u", rank="r", tie="m")
    second = lambda t: t.replace(microsecond=0)
    want = set()
    for i, s, t in index:
        near = [(r, abs((second(t) - second(u)).total_seconds()), m) for m, s2, u, r in measures if s2 == s and u is not None]
        if near:
            want.add((i, min(near)[2]))
    assert {(r["i"], r["m"]) for r in out.collect()} == want and out.columns == ["i", "s", "t", "m", "u", "r", "seconds"]


def test_rules_match_as_every_pair_does(spark):
    rng = random.Random(7)
    code = lambda n: "".join(rng.choice("ab1") for _ in range(n))
    rows = [(i, code(rng.randrange(0, 5)) if i % 11 else None, rng.choice(["X", "y ", None])) for i in range(120)]
    catalog = {(f"r{rng.randrange(9)}", "d", rng.choice(["ANY", "X", "Y"]), code(rng.randrange(1, 4)), kind, True) for kind in ("exact", "prefix") for _ in range(25)}
    catalog |= {("p", "d", "X", "^A.*1$", "regex", True), ("q", "d", "ANY", "B1", "regex", True), ("off", "d", "ANY", "A", "prefix", False)}
    import re

    want = set()
    for i, c, s in rows:
        for rule, _, system, pattern, kind, include in catalog:
            if c is None or not include or (system != "ANY" and system != (s or "").strip().upper()):
                continue
            c2 = c.strip().upper()
            hit = c2 == pattern.upper() if kind == "exact" else c2.startswith(pattern.upper()) if kind == "prefix" else re.search(pattern, c2)
            if hit:
                want.add((i, rule))
    df = spark.createDataFrame(rows, "i long, c string, s string")
    out = rules.match_codes(df, rules.catalog(spark, sorted(catalog)), code="c", system="s")
    assert sorted((r["i"], r["rule"]) for r in out.collect()) == sorted(want)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    with pytest.raises(ValueError):
        rules.match_codes(df, spark.range(1001).selectExpr("'r' rule", "'d' domain", "'ANY' code_system", "concat('a', id) code", "'regex' match_type", "true include"), code="c")


def test_no_shared_folder_is_an_error_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class Spark:
        conf = Conf()
        sparkContext = type("C", (), {"master": "spark://somewhere:7077", "applicationId": "x"})()

    with pytest.raises(RuntimeError):
        shared.folder(Spark())
