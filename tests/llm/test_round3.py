"""Fill-in-the-middle, MinHash groups and hard negatives against brute force, with every awkward input."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairn.llm import bands, common, fim, graph, hardneg, minhash

WORDS = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar papa quebec romeo sierra tango".split()
SCHEMA = "doc_id long, text string, n long, form string, output string, node long, band long, kept boolean"


def prose(seed: int, n: int, vocab=WORDS) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(vocab) for _ in range(n))


TEXTS = [None, "", "   ", "\t\x0b ", "a", "été  日本 \U0001f600 ß\n", prose(1, 300), prose(1, 300), " lead and trail \n\n", "x" * 5000, "has <P> inside", "almost <S and <P", "<", ">", "a\x1cb\x85c\xa0d", prose(2, 20_000)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, 1, "x", "y", 2, 3, True) for i, t in enumerate(TEXTS)] + [(i, prose(i, 12 + i % 9) + " end\n" * (i % 3), 1, "x", "y", 2, 3, True) for i in range(100, 300)]
    rows += [rows[6], (None, "null key " + prose(5, 50), 1, "x", "y", 2, 3, True), (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


# ---- 11 fill in the middle ------------------------------------------------------------------------


def plain_fim(doc_id, text):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 80:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def test_fill_in_middle(spark, docs):
    got = sorted(map(repr, ((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output_sha256"], r["restored_sha256"]) for r in fim.digests(docs).collect())))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for r in docs.collect():
        *head, out = plain_fim(r["doc_id"], r["text"])
        want.append((r["doc_id"], *head, sha(out), sha(r["text"] or "")))
    assert got == sorted(map(repr, want))
    assert {"plain", "psm", "spm"} == {w[2] for w in want}
    assert fim.digests(docs.limit(0)).count() == 0


def test_fill_in_middle_carries_columns(docs):
    made = fim.transform(docs)
    assert set(made.columns) == set(docs.columns) | {"prefix_chars", "middle_chars"}
    back = made.select("text", fim.restored(F.col("output"), F.col("form")).alias("back")).collect()
    assert all((r["text"] or "") == r["back"] for r in back)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and plan.count("Exchange") == 1  # the fixture's own


def test_fill_in_middle_of_megabytes(spark):
    long = prose(3, 500_000)
    df = spark.createDataFrame([(i, t) for i in range(6) for t in (long, "y" * 2_000_000, " " * 300_000 + "z")], "doc_id long, text string")
    made = fim.digests(df).collect()
    assert all(r["restored_sha256"] in {hashlib.sha256(t.encode()).hexdigest() for t in (long, "y" * 2_000_000, " " * 300_000 + "z")} for r in made)
    assert {r["n"] for r in made} == {500_000, 1}


# ---- 12 MinHash -----------------------------------------------------------------------------------


def word_set(text, n=2):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def brute_groups(rows):
    sets = [word_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), 1 << 60), d)
    return [(d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def awkward(seed=0):
    """Copies, near copies around the threshold, a template whose texts are alike but not linked, chains, short and empty texts."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(2000)]
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(6, TEXTS[6]), (None, TEXTS[7].upper()), (None, None), (20, "One"), (21, "one"), (22, "one two"), (23, "one two one two"), (24, "two one two one two")]
    for i in range(60):
        words = [rng.choice(vocab) for _ in range(rng.choice([8, 30, 200]))]
        rows.append((100 + i, " ".join(words)))
        for j in range(3):
            copy = list(words)
            for _ in range(rng.choice([0, 1, len(words) // 20, len(words) // 10])):
                copy[rng.randrange(len(words))] = rng.choice(vocab)
            rows.append((1000 * (j + 1) + i, " ".join(copy)))
    base = [f"t{j}" for j in range(100)]
    rows += [(9000 + i, " ".join(base + [f"own{i}x{j}" for j in range(rng.choice([13, 12, 11, 10]))])) for i in range(90)]
    chain = [f"c{j}" for j in range(200)]
    for i in range(50):
        chain[(4 * i) % 200] = f"new{i}"
        rows.append((9500 + i, " ".join(chain)))
    return rows


@pytest.mark.parametrize("bucket", [bands.BUCKET, 12])
def test_minhash_groups(spark, bucket):
    rows = awkward()
    df = spark.createDataFrame([(*r, 1, "x", True) for r in rows], "doc_id long, text string, node long, own string, kept boolean").repartition(4)
    got = minhash.groups(spark, df, bucket=bucket).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], repr(r[2]))
    want = sorted(brute_groups(rows), key=key)
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=key) == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    assert len({c for _, _, c in want}) < len(rows)


def test_minhash_of_nothing(spark, docs):
    assert minhash.groups(spark, docs.limit(0)).count() == 0
    blank = spark.createDataFrame([(3, None), (1, " "), (2, "")], "doc_id long, text string")
    assert sorted(map(tuple, minhash.groups(spark, blank).collect())) == [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True)]


def test_posterior_is_the_beta_tail():
    """The binomial form equals a numerical integral of the posterior density."""
    x = np.linspace(0, 1, 200_001)
    for m, n in ((3, 8), (20, 32), (100, 128)):
        density = x**m * (1 - x) ** (n - m)
        assert abs(density[x >= 0.8].sum() / density.sum() - minhash.posterior(m, n, 0.8)) < 1e-4
    assert minhash.posterior(minhash.least_matches(64, 0.8, 1e-6), 64, 0.8) >= 1e-6 > minhash.posterior(minhash.least_matches(64, 0.8, 1e-6) - 1, 64, 0.8)


def test_verification_keeps_similar_pairs():
    """Pairs at the wanted similarity go on through all batches; dissimilar ones end early."""
    rng = np.random.default_rng(5)
    allow = minhash.scheme().plausible
    common_part = rng.integers(0, 2**64, size=(400, 80), dtype=np.uint64)
    own = rng.integers(0, 2**64, size=(2, 400, 60), dtype=np.uint64)
    values = lambda k, n: np.array([minhash.signature(np.concatenate((c, o[:n]))) for c, o in zip(common_part, own[k])])
    assert allow(values(0, 10), values(1, 10)).all()  # 80 / 100
    assert not allow(values(0, 60), values(1, 60)).any()  # 80 / 200


def shuffled_rows(spark, count, bucket):
    """Rows of the second round for a band of near copies, all linked but every tenth."""
    nodes = spark.range(count).select(F.col("id").alias("node"), F.lit(0).cast("long").alias("s0"), F.lit(0).cast("long").alias("s1"), F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.when(i == 0, F.lit(1)).otherwise(F.hash("id", i)).cast("long")).alias("whole"))
    keys = lambda first, n: F.expr(f"transform(slice(whole, {first}, {n}), (x, i) -> xxhash64(i, x))")
    seen = spark.sparkContext.accumulator(0)

    def plausible(a, b):
        return np.zeros(len(a), dtype=bool)

    scheme = bands.Scheme(keys(1, 1), F.expr("transform(slice(whole, 2, 3), (x, i) -> xxhash64(i, x & 63))"), 1, 128, plausible, *[lambda a, b: np.zeros(len(a), dtype=np.int64)] * 2)
    counted = bands._by_group

    def count_rows(batches):
        for piece in counted(batches):
            seen.add(len(piece[0]))
            yield piece

    bands._by_group = count_rows
    try:
        bands.links(spark, nodes, scheme, None, 0.8, bucket=bucket).count()
    finally:
        bands._by_group = counted
    return seen.value


def test_crowded_bands_get_longer_keys(spark):
    """Chance meetings in one band: four times the rows are dealt out for four times the rows, not sixteen times."""
    small, large = shuffled_rows(spark, 2_000, 500), shuffled_rows(spark, 8_000, 500)
    assert small > 0 and large <= 4.2 * small


# ---- 13 hard negatives ----------------------------------------------------------------------------


def brute_mined(rows, anchors_every=100):
    part = []
    for vec_id, v, label in rows:
        if label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        part.append((vec_id, [int(np.floor(256.0 * float(x))) for x in v], (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label))
    order = lambda r: (-r[1], r[0] is None, r[0] or 0)
    out = []
    for i, (aid, aq, al) in enumerate(part):
        if aid is None or aid % anchors_every:
            continue
        scored = [(r[0], sum(x * y for x, y in zip(aq, r[1])), r[2]) for j, r in enumerate(part) if j != i]
        for pid, p, _ in sorted((s for s in scored if s[2] == al), key=order)[:5]:
            fits = sorted((s for s in scored if s[2] != al and 80 * p <= 100 * s[1] <= 100 * p), key=order)[:5]
            out += [(aid, pid, rank + 1, n, p, s) for rank, (n, s, _) in enumerate(fits)]
    return sorted(out, key=repr)


def vectors(kind, seed=3):
    rng = np.random.default_rng(seed)
    n, dim = 900, 12
    x = rng.normal(size=(n, dim))
    if kind == "norms":  # few long vectors, many short ones
        x *= (rng.pareto(1.5, size=n) + 0.05)[:, None]
    if kind == "large":
        x *= 1e5
    rows = [(i if i % 11 else 10 * i, x[i].tolist(), int(rng.integers(0, 3)) if i % 3 else 4) for i in range(n)]
    rows += [rows[0], rows[100], rows[7], (None, x[3].tolist(), 4), (None, (2 * x[0]).tolist(), 1), (1000_00, None, 4), (200, x[5].tolist(), None), (300, [float("nan")] + x[0].tolist()[1:], 4), (400, [float("inf")] + x[0].tolist()[1:], 4), (500, [None] + x[0].tolist()[1:], 4), (600, [0.0] * dim, 4)]
    return rows


@pytest.mark.parametrize("kind, part_rows", [("plain", None), ("plain", 40), ("norms", 40), ("large", 100)])
def test_hard_negatives(spark, kind, part_rows):
    rows = vectors(kind)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, label int, part int, q string").repartition(5)
    got = hardneg.mine(spark, df, part_rows=part_rows, bucket_rows=16)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = brute_mined(rows)
    assert len(want) > 50 and sorted(map(tuple, got.collect()), key=repr) == want


def test_hard_negatives_of_little(spark):
    kind = "vec_id long, embedding array<float>, label int"
    assert hardneg.mine(spark, spark.createDataFrame([], kind)).count() == 0
    assert hardneg.mine(spark, spark.createDataFrame([(0, None, 1), (100, [1.0], None)], kind)).count() == 0
    few = [(0, [1.0, 1.0], 2), (3, [1.0, 0.5], 2), (4, [1.0, 0.5], 1), (5, [0.8, 0.5], 9), (6, [1.0, 1.0, 1.0], 2), (8, [1e30, 1.0], 1)]
    assert sorted(map(tuple, hardneg.mine(spark, spark.createDataFrame(few, kind)).collect())) == brute_mined([r for r in few if r[0] not in (6, 8)])


def test_long_vectors_spare_short_ones(spark, monkeypatch):
    """Parts whose rows are too short for what an anchor has found get no anchors."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(4000, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[:400] *= 50
    df = spark.createDataFrame([(i, v.tolist(), i % 2) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    rows, bounds = hardneg.parts(spark, hardneg.usable(df), 100)
    assert sum(n for _, n in bounds) == 4000 and [b for b, _ in bounds] == sorted((b for b, _ in bounds), reverse=True)
    asked = []
    plain = hardneg._asked
    monkeypatch.setattr(hardneg, "_asked", lambda spark, rows, anchors, bounds, first, last, **k: (asked.append((first, last, anchors)), plain(spark, rows, anchors, bounds, first, last, **k))[1])
    hardneg.mine(spark, df, part_rows=100).collect()
    first, last, anchors = asked[2]  # the positives' third round
    needs = [(r["norm"], r["windows"][0]["known"]) for r in anchors.collect()]
    assert len(needs) == 40 and sum(hardneg._reach(n, bounds[first][0]) >= k for n, k in needs) < 40


def test_labels_of_a_third_of_all_rows_are_no_hot_task(spark):
    df = spark.createDataFrame([(i, [float(i % 17), 1.0 + i % 5], 3 if i % 3 else i % 9) for i in range(3000)], "vec_id long, embedding array<float>, label int")
    _, bounds = hardneg.parts(spark, hardneg.usable(df), 250)
    assert max(n for _, n in bounds) < 600
