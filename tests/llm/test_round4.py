"""Findings of the third round: nearest neighbours of other rows, and what the later rounds of the near-duplicate search move."""

import os
import random
import time

import numpy as np
import pytest

from cairn.llm import ann, common, graph, minhash, simhash


def other_rows(kind):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(12_000, 128 if kind == "many dimensions" else 24)).astype(np.float32)
    if kind == "queries unlike the rest":
        rest = np.arange(len(x)) % 20 != 0
        x[rest] = x[1] + 0.02 * x[rest]
    if kind == "few long rows":
        x[rng.choice(len(x), 60, replace=False)] *= 50
    return x


@pytest.mark.parametrize("kind", ["queries unlike the rest", "few long rows", "many dimensions"])
def test_nearest_of_other_rows(spark, kind):
    """No true neighbour is missed, whatever the rows are like."""
    x = other_rows(kind)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.astype(float).tolist())], "vec_id long, embedding array<float>")
    got = ann.nearest(spark, df, every=200, part_rows=3_000).toPandas()
    x = x.astype(np.float64)
    for q, g in got.groupby("query_id"):
        scores = x @ x[q]
        scores[q] = -np.inf
        want = np.lexsort((np.arange(len(x)), -scores))[:20]
        assert g.sort_values("rank").vec_id.tolist() == want.tolist()
    assert got.query_id.nunique() == 60


def test_bounds_hold():
    rng = np.random.default_rng(1)
    unit = lambda n: ann._unit(rng.normal(size=(n, 3)))
    rows, centre, query = unit(500), unit(500), unit(500)
    dot = lambda a, b: np.einsum("nd,nd->n", a, b)
    assert (dot(rows, query) <= ann.most_cosine(dot(query, centre), dot(rows, centre), ann.ROUNDING)).all()


def tags_of(monkeypatch):
    tags, written = [], common.written
    monkeypatch.setattr(common, "written", lambda spark, df, tag, path=None: (tags.append(tag), written(spark, df, tag, path))[1])
    return tags


def test_stars_need_no_round(spark, monkeypatch):
    """Links that are stars already are written once."""
    tags = tags_of(monkeypatch)
    stars = spark.createDataFrame([(i, i % 3) for i in range(3, 60)], "a long, b long")
    assert {(r["node"], r["root"]) for r in graph.components(spark, stars).collect()} == {(i, i % 3) for i in range(3, 60)}
    assert tags == ["links"]
    chain = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(100, 101), (200, 200)], "a long, b long")
    assert {(r["node"], r["root"]) for r in graph.components(spark, chain).collect()} == {(i, 0) for i in range(1, 31)} | {(101, 100)}
    assert graph.components(spark, stars.limit(0)).count() == 0


def template_rows():
    """Texts of one template, alike but hardly ever similar enough, and some near copies of them."""
    rng = random.Random(4)
    frame, words = [f"frame{i}" for i in range(40)], [f"w{i}" for i in range(500)]
    rows = []
    for i in range(300):
        own = frame + rng.choices(words, k=8)
        rows.append((2 * i, " ".join(own)))
        if i % 10 == 0:
            rows.append((2 * i + 1, " ".join([*own[:-1], "other"])))
    return rows


def brute(rows, n, similarity=0.8):
    sets = {k: {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} for k, w in ((k, t.split()) for k, t in rows)}
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: find(k) for k in sets}


@pytest.mark.parametrize("module", [minhash, simhash])
def test_unfruitful_rounds_end_and_leave_little_on_disk(spark, monkeypatch, module):
    """Rounds that link little are not repeated, no link is lost by that, and what nothing reads any more is gone."""
    rows = template_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    tags, gone = tags_of(monkeypatch), []
    monkeypatch.setattr(common, "drop", lambda *tables, drop=common.drop: (gone.extend(f for t in tables for f in t.inputFiles()), drop(*tables))[1])
    out = (minhash.groups(spark, docs) if module is minhash else simhash.similar_groups(spark, docs)).collect()
    assert {r["doc_id"]: r["component_id"] for r in out} == brute(rows, 2 if module is minhash else simhash.WIDE_SHINGLE)
    assert tags.count("likeliest") <= 2
    assert gone and not any(os.path.exists(f.replace("file://", "")) for f in gone)


def test_shuffle_files_go_with_their_query(spark):
    blocks = lambda: sum("shuffle" in b for b in map(str, spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(" ").split()))
    before = blocks()
    common.written(spark, spark.range(5_000).selectExpr("id % 700 AS k").groupBy("k").count().repartition(3, "count"), "counted")
    for _ in range(50):
        if blocks() <= before:
            return
        time.sleep(0.1)
    raise AssertionError("shuffle files are still there")
