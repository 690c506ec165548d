"""Findings of the third round's check: rounds of the components, and what is read again."""

import random

import numpy as np
import pytest

from cairn.llm import graph, tokens


def roots_of(links):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {(x, find(x)) for x in parent if find(x) != x}


def test_local_stars():
    rng = np.random.default_rng(4)
    for n in range(1, 120):
        a, b = rng.integers(0, n, size=(2, n))
        node, root = graph.local_stars(a, b)
        assert set(zip(node.tolist(), root.tolist())) == roots_of(zip(a.tolist(), b.tolist()))


@pytest.mark.parametrize("few_links", [0, graph.FEW_LINKS])
@pytest.mark.parametrize("kind", ["chain", "tree", "hubs", "empty"])
def test_components_in_small_steps(spark, kind, few_links):
    """Whatever a task sees at a time, each linked node stands once, with its component's smallest."""
    rng = random.Random(6)
    links = {
        "chain": [(i, i + 1) for i in range(60)] + [(-5, -5)],
        "tree": [(i, rng.randrange(i)) for i in range(1, 90)],
        "hubs": [(i % 4, i) for i in range(100)] * 2 + [(200, 3)],
        "empty": [],
    }[kind]
    rng.shuffle(links)
    rows = graph.components(spark, spark.createDataFrame(links, "a long, b long").repartition(7), at_once=3, few_links=few_links).collect()
    assert len(rows) == len({r["node"] for r in rows})
    assert {(r["node"], r["root"]) for r in rows} == roots_of(links)


def test_a_share_of_links_needs_no_rounds(spark, monkeypatch):
    """Links that one task may hold are written once; before, a chain of 400 took several rounds of two stars each."""
    tags, written = [], graph.common.written
    monkeypatch.setattr(graph.common, "written", lambda spark, df, tag, path=None: (tags.append(tag), written(spark, df, tag, path))[1])
    found = graph.components(spark, spark.createDataFrame([(i, i + 1) for i in range(400)], "a long, b long"))
    assert {(r["node"], r["root"]) for r in found.collect()} == {(i, 0) for i in range(1, 401)}
    assert tags == ["links"]


def test_known_runs_are_not_split_again(monkeypatch):
    """Runs between white space are looked up whole, with the library's ids; a full cache changes nothing."""
    class Split:
        calls = 0

        def findall(self, text):
            Split.calls += 1
            return found(text)

    found = tokens._SPLIT.findall
    monkeypatch.setattr(tokens, "_SPLIT", Split())
    texts = ["Don't stop, it's 3.14\n(or \"so\")...", "Über-große  it's 2x4", "it's\t3.14 ((", "", " \n"]
    for cache_words in (1, 250_000):
        enc = tokens.WordEncoder(tokens.vocab_path(), cache_words=cache_words)
        for _ in range(3):
            assert [x.tolist() for x in enc.encode_many(texts)] == [enc.whole(t).tolist() for t in texts]
            assert enc.count_many(texts) == [len(enc.whole(t)) for t in texts]
    before = Split.calls
    list(enc.encode_many(texts))
    assert Split.calls == before
