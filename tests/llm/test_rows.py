"""Near-duplicate stages drop rows, never keys."""

import random

import pytest

from cairn.llm import simhash

WORDS = [f"w{i}" for i in range(500)]
SCHEMA = "doc_id long, text string, n int"


def prose(seed, n=60):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


def brute_keep(rows, group):
    """One row of each group, the least (key first); rows without a key all stay."""
    best = {}
    for at, (key, text, _) in enumerate(rows):
        if key is not None:
            g = group(text)
            if g not in best or key < rows[best[g]][0]:
                best[g] = at
    return sorted((rows[at][0], group(rows[at][1])) for at in best.values()) + sorted(("none", group(t)) for k, t, _ in rows if k is None)


def kept_of(out, group):
    got = [(r["doc_id"], group(r["text"])) for r in out.collect()]
    return sorted(x for x in got if x[0] is not None) + sorted(("none", g) for k, g in got if k is None)


@pytest.mark.parametrize("keep", [simhash.keep_dissimilar, simhash.keep_one])
def test_texts_without_a_duplicate_stay_when_keys_repeat(spark, keep):
    a, b, c, d = (prose(i) for i in range(4))
    rows = [(1, a, 0), (5, b, 0), (5, c, 0), (7, d, 0), (7, a, 0)]
    out = keep(spark, spark.createDataFrame(rows, SCHEMA))
    assert out.columns == ["doc_id", "text", "n"]
    assert sorted((r["doc_id"], r["text"]) for r in out.collect()) == sorted([(1, a), (5, b), (5, c), (7, d)])


@pytest.mark.parametrize("keep, drop_rows", [(simhash.keep_dissimilar, 10**6), (simhash.keep_dissimilar, 0), (simhash.keep_one, 0)])
def test_rows_of_repeated_keys_equal_brute_force(spark, keep, drop_rows):
    rng = random.Random(3)
    base = [prose(i) for i in range(12)] + ["", None, "  "]
    group = lambda t: " ".join((t or "").upper().split())  # noqa: E731  the same words: the same group, all others are far apart
    for seed in range(2):
        rows = []
        for _ in range(70):
            t = rng.choice(base)
            rows.append((rng.choice([None, *range(6)]), t.upper() if t and rng.random() < 0.3 else t, rng.randrange(3)))
        out = keep(spark, spark.createDataFrame(rows, SCHEMA), drop_rows=drop_rows)
        assert kept_of(out, group) == brute_keep(rows, group), seed
