"""Vectors of extreme length, repetitive texts and texts with very many matches."""

import hashlib
import random
import resource
import time

import numpy as np
import pytest

from cairn.llm import ann, decontaminate, pii, secrets


@pytest.mark.parametrize("lengths", [[1e-200], [1e200], [1e-200, 1.0, 1e100], [5e-324, 1e300, 1.0]])
def test_nearest_of_extreme_lengths(spark, lengths):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(1500, 16))
    x[::97] *= np.resize(lengths, len(x[::97]))[:, None]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got: dict = {}
    for r in ann.nearest(spark, df, every=20).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    taking_part = np.flatnonzero((x != 0).any(axis=1))
    queries = [i for i in taking_part.tolist() if i % 20 == 0]
    assert sorted(got) == queries
    hits = 0
    with np.errstate(all="ignore"):
        for q in queries:
            scores = {i: float(np.einsum("d,d->", x[i], x[q])) for i in taking_part.tolist() if i != q}
            want = sorted(scores, key=lambda i: (np.isnan(scores[i]), -scores[i] if scores[i] == scores[i] else 0, i))[:20]
            found = sorted(got[q])
            assert len(found) == 20 and all(np.isclose(s, scores[i], rtol=1e-12, atol=0) or np.isnan(s) for _, i, s in found)
            least = scores[want[-1]]
            hits += sum(scores[i] >= least for _, i, _ in found)
    assert hits >= 0.9 * 20 * len(queries)


def test_tiles_by_length_are_the_same_tiles():
    rng = random.Random(1)
    for _ in range(500):
        k = rng.choice([1, 2, 3, 8])
        doc, item = (np.array([rng.randrange(k) for _ in range(rng.randrange(1, n))]) for n in (60, 30))
        length = min(rng.choice([2, 3, 5]), len(item))
        places = decontaminate._places(decontaminate.running_hashes(doc, length), decontaminate.running_hashes(item, length))
        assert decontaminate.tile(doc, item, length) == decontaminate._tile_by_length(doc, item, length, np.flatnonzero(places[2]))


def test_repetitive_texts_fit():
    """A million equal words against items of a thousand words: no list of pairs."""
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    doc = np.zeros(1_000_000, dtype=np.int64)
    for item, covered in ((np.zeros(1000, dtype=np.int64), 1000), (np.append(np.zeros(999, dtype=np.int64), 1), 999), (np.where(np.arange(1000) % 6 == 5, np.arange(1000), 0), 830)):
        assert sum(n for *_, n in decontaminate.tile(doc, item, 5)) == covered
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 500 * 1024


def test_a_text_with_very_many_secrets(spark):
    many = " ".join(hashlib.sha1(str(i).encode()).hexdigest()[:24] for i in range(200_000))
    df = spark.createDataFrame([(1, many, "a"), (2, "token=abcdef1 " * 50_000, "b"), (3, "none", "c")], "doc_id long, text string, source string")
    began = time.monotonic()
    got = {r["doc_id"]: r for r in secrets.scan(spark, df).collect()}
    assert time.monotonic() - began < 90
    assert (got[1]["n_hex"], got[2]["n_assign"], got[3]["spans"]) == (200_000, 50_000, "")
    assert got[1]["spans"].startswith("hex:0:24,live:0:24,") and got[2]["spans"].endswith(f"assign:{14 * 49_999}:{14 * 50_000 - 1}")


def test_coreference_is_counted_over_the_corpus(spark):
    """A mail address or a number has one surrogate wherever it stands; a name has one for each gender that its titles give."""
    text = ["Mail bob.lee9@mail1.example.com or call +1 415 555 2671.", "bob.lee9@mail1.example.com again; Mrs Jean Dupont met us.", "Mr Jean Dupont was there. +1 415 555 2671", None, ""]
    made = pii.pseudonymise(spark.createDataFrame([(i, t) for i, t in enumerate(text)], "doc_id long, text string"), key=b"k", digests="entities")
    assert pii.collisions(made).count() == 0
    assert {r["kind"] for r in pii.splits(made).collect()} <= {"name", "person"} and pii.splits(made.filter("doc_id <> 2")).count() == 0
