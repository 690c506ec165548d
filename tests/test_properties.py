"""Properties that hold for any input: time windows, reductions and joins against plain Python."""

import datetime as dt
import random

from pyspark.sql import functions as F

from cairn.functions import temporal
from cairn.operators import aggregate, joins, order, reduce, rules

EPOCH = dt.datetime(2024, 1, 1)


def moments(seed, n):
    rng = random.Random(seed)
    edges = [dt.timedelta(days=d, microseconds=us) for d in (0, 1, 7, 14) for us in (-1, 0, 1)]
    return [EPOCH + (rng.choice(edges) if rng.random() < 0.4 else dt.timedelta(seconds=rng.randrange(40 * 86400), microseconds=rng.randrange(10**6))) for _ in range(n)]


def test_windows_equal_python(spark):
    rows = [(e, k, i) for e, k, i in zip(moments(1, 300), [random.Random(j).choice(["date_only", "timestamp"]) for j in range(300)], moments(2, 300))]
    df = spark.createDataFrame(rows, "event timestamp_ntz, kind string, index timestamp_ntz")
    day = lambda t: t.replace(hour=0, minute=0, second=0, microsecond=0)
    got = df.select("*", temporal.in_look_back(F.col("event"), F.col("kind"), F.col("index"), 7).alias("back"), temporal.in_follow_up(F.col("event"), F.col("kind"), F.col("index"), 1, 14).alias("ahead"), temporal.boundaries("day", F.col("index"), F.col("event")).alias("days"), temporal.boundaries("hour", F.col("index"), F.col("event")).alias("hours")).collect()
    for r in got:
        e, i = (day(r["event"]), day(r["index"])) if r["kind"] == "date_only" else (r["event"], r["index"])
        assert r["back"] == (i - dt.timedelta(7) <= e <= i)
        assert r["ahead"] == (i + dt.timedelta(1) <= e <= i + dt.timedelta(14))
        assert r["days"] == (day(r["event"]) - day(r["index"])).days
        hour = lambda t: t.replace(minute=0, second=0, microsecond=0)
        assert r["hours"] == (hour(r["event"]) - hour(r["index"])).total_seconds() // 3600


def events(seed, n=400):
    rng = random.Random(seed)
    return [(rng.randrange(12), rng.choice([None, rng.randrange(5)]), EPOCH + dt.timedelta(hours=rng.randrange(30)), i, rng.choice([None, float(rng.randrange(9))])) for i in range(n)]


def test_reductions_equal_python(spark):
    rows = events(3)
    df = spark.createDataFrame(rows, "p int, e int, ts timestamp_ntz, id int, v double").repartition(5)
    last = lambda x: (x is None, x)  # noqa: E731  nulls last
    first, highest = {}, {}
    for p, e, ts, i, v in rows:
        key = (p, e)
        if key not in first or (ts, i) < first[key][:2]:
            first[key] = (ts, i)
        rank = (v is None, -(v or 0), i)
        if key not in highest or rank < highest[key]:
            highest[key] = rank
    best = {}
    for (p, e), (ts, i) in first.items():
        rank = (ts, (e is None, e or 0), i)
        if p not in best or rank < best[p]:
            best[p] = rank
    got = {r["p"]: r["id"] for r in reduce.two_level_first(df, patient="p", encounter="e", ts="ts", tie="id").collect()}
    assert got == {p: r[2] for p, r in best.items()}
    top = {}
    for (p, e), rank in highest.items():
        key = (rank[0], rank[1], (e is None, -(e or 0)), rank[2])
        if p not in top or key < top[p]:
            top[p] = key
    got = {r["p"]: r["id"] for r in reduce.two_level_highest(df, patient="p", encounter="e", value="v", tie="id").collect()}
    assert got == {p: r[3] for p, r in top.items()}
    assert last(None) > last(1)


def test_as_of_joins_equal_python(spark):
    left = [(i, i % 12, EPOCH + dt.timedelta(hours=random.Random(i).randrange(30))) for i in range(60)]
    right = [(p, ts, i) for p, _, ts, i, _ in events(4)]
    a = spark.createDataFrame(left, "id int, k int, ts timestamp_ntz")
    b = spark.createDataFrame(right, "k int, rts timestamp_ntz, rid int")
    back = {r["id"]: r["rid"] for r in joins.as_of_backward(a, b, ["k"], left_ts="ts", right_ts="rts", values=["rid"], tie="rid", left_id=["id"]).collect()}
    ahead = {r["id"]: r["rid"] for r in joins.as_of_forward(a, b, ["k"], left_ts="ts", right_ts="rts", first_days=0, last_days=1, values=["rid"], tie="rid", left_id=["id"]).collect()}
    for i, k, ts in left:
        assert back[i] == max(((t, r) for p, t, r in right if p == k and t < ts), default=(None, None))[1]
        assert ahead[i] == min(((t, r) for p, t, r in right if p == k and ts <= t <= ts + dt.timedelta(1)), default=(None, None))[1]


def test_code_matching_equals_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice("AB") + str(rng.randrange(30)), rng.choice(["S-1", "s1", "S2", None])) for i in range(200)]
    cat = [("r%d" % i, "d", rng.choice(["S1", "S2", "ANY"]), rng.choice("AB") + str(rng.randrange(12)), rng.choice(["exact", "prefix"]), rng.random() < 0.8) for i in range(25)]
    df = spark.createDataFrame(rows, "id int, code string, system string")
    norm = lambda s: "".join(ch for ch in (s or "").upper() if ch.isalnum())
    want = sorted((i, r) for i, c, s in rows for r, _, rs, rc, kind, on in cat if on and (rs == "ANY" or (s is not None and norm(rs) == norm(s))) and (c == rc if kind == "exact" else c.startswith(rc)))
    got = sorted((r["id"], r["rule"]) for r in rules.match_codes(df, rules.catalog(spark, cat), code="code", system="system").collect())
    assert got == want
    assert sorted({i for i, _ in want}) == sorted(r["id"] for r in df.filter(rules.predicate([(s, c, m) for _, _, s, c, m, on in cat if on], F.col("code"), F.col("system"))).collect())


def test_row_order_and_conflicts(spark):
    df = spark.createDataFrame([(x,) for x in random.Random(6).sample(range(1000), 300)], "id int").repartition(4)
    got = [(r["id"], r["row_order"]) for r in order.row_order(spark, df, ["id"]).collect()]
    assert sorted(got) == [(x, i + 1) for i, x in enumerate(sorted(x for x, _ in got))]
    kinds = spark.createDataFrame([(1, "a"), (1, "b"), (1, "a"), (2, "a"), (3, "b"), (3, "a"), (4, None)], "k int, t string")
    assert [tuple(r) for r in aggregate.conflicts(kinds, "k", "t").collect()] == [("a+b", 2)]
