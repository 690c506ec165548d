"""The whole pipeline over the smallest tables against plain Python, stage by stage; held-out language accuracy."""

import math
import os
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_quality import PlainKneserNey

import corpus_pipeline
from cairn.llm import common, decontaminate, langid, pii, quality, simhash, tokens

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")


def good_rows(rows, labels, spark):
    """Rows whose plain Kneser-Ney perplexity is at most their language's quantile."""
    fold = {r["doc_id"]: r["trusted"] for r in quality.trusted_ids(labels).collect()}
    lang = lambda r: r["lang"] or "und"
    texts = defaultdict(list)
    for r in rows:
        if fold.get(r["doc_id"]):
            texts[lang(r)].append(r["text"])
    models = {k: PlainKneserNey(v) for k, v in texts.items()} | {"*": PlainKneserNey([t for v in texts.values() for t in v])}
    score = [models.get(lang(r), models["*"]).perplexity(r["text"]) for r in rows]
    held = defaultdict(list)
    for r, s in zip(rows, score):
        if fold.get(r["doc_id"]) is False:
            held[lang(r)].append(s)
    at = lambda v: sorted(v)[math.ceil(quality.QUANTILE * len(v)) - 1]
    whole = at([s for v in held.values() for s in v])
    return [r for r, s in zip(rows, score) if s <= (at(held[lang(r)]) if held[lang(r)] else whole) * (1 + 1e-12)]


def distinct_rows(rows):
    """Of each group of rows linked by a similarity of 0.8 or more, the one with the least key."""
    sets = [set(simhash.shingle_set(r["text"]).tolist()) for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if (not a and not b) or (min(len(a), len(b)) >= 0.8 * max(len(a), len(b)) and len(a & b) >= 0.8 * len(a | b)):
                parent[find(i)] = find(j)
    best = {}
    for i, r in enumerate(rows):
        best[find(i)] = min(best.get(find(i), r), r, key=lambda x: x["doc_id"])
    return list(best.values())


def clean_rows(rows, items):
    """Rows of which no item is covered by tiles; every item is tried on every row."""
    numbers = {}
    ids = lambda t: np.array([numbers.setdefault(w, len(numbers)) for w in decontaminate.words_of(t)], dtype=np.int64)
    wanted = [ids(t) for t in items if decontaminate.words_of(t)]
    out = []
    for r in rows:
        words = ids(r["text"])
        covered = lambda item: sum(n for *_, n in decontaminate.tile(words, item, min(decontaminate.MIN_MATCH, len(item)))) / len(item)
        if not any(covered(item) >= decontaminate.COVERAGE for item in wanted):
            out.append(r)
    return out


def test_pipeline_equals_plain_python(spark):
    spark.conf.set(pii.KEY_SETTING, "test key")
    try:
        table = lambda name: common.table(spark, SF, name)
        rows = table("documents").collect()
        assert len({r["doc_id"] for r in rows}) == len(rows)
        docs = table("documents")
        seen = {}
        for name, stage in corpus_pipeline.STAGES:
            docs = common.written(spark, stage(spark, docs, SF), name)
            seen[name] = docs.collect()
        keys = lambda found: sorted(r["doc_id"] for r in found)
        good = good_rows(rows, table("labels"), spark)
        assert keys(seen["quality"]) == keys(good) and 0 < len(good) < len(rows)
        single = distinct_rows(seen["quality"])
        assert keys(seen["near_dedup"]) == keys(single) and len(single) < len(good)
        clean = clean_rows(single, [r["text"] for r in table("benchmark").collect()])
        assert keys(seen["decontamination"]) == keys(clean) and len(clean) < len(single)
        made = pii.Surrogates(b"test key")
        want = {r["doc_id"]: r["text"] and made.replace(r["text"])[0] for r in clean}
        assert {r["doc_id"]: r["text"] for r in seen["pii"]} == want and any(want[r["doc_id"]] != r["text"] for r in clean)
        assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in seen["pii"])
        enc, pieces, ends = tokens.WordEncoder(tokens.vocab_path()), defaultdict(int), defaultdict(int)
        for r in seen["packing"]:
            pieces[r["doc_id"]] += r["length"]
            ends[r["sequence_id"]] += r["length"]
        assert dict(pieces) == {k: len(enc.whole(t or "")) + 1 for k, t in want.items()} and max(ends.values()) <= 2048
        again = corpus_pipeline.run(spark, SF).select("doc_id", "piece", "ids_crc32").collect()
        assert sorted(map(tuple, again)) == sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in seen["packing"])
    finally:
        spark.conf.unset(pii.KEY_SETTING)


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = langid.identify(spark, docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out AND lang IS NOT NULL AND lang_pred <> 'und'")
    n, right = found.agg(F.count("*"), F.count_if(F.col("lang") == F.col("lang_pred"))).first()
    assert n > 100 and right >= 0.98 * n
