"""Findings of the fifth check: operator 12 beyond the check's sizes."""

import random

import pyarrow as pa
from pyspark.sql import functions as F

from cairn.llm import graph, minhash


def test_links_of_a_large_corpus_need_no_rounds(spark, monkeypatch):
    """300,000 links are one task's share; before, they took rounds of several jobs each."""
    tags, written = [], graph.common.written
    monkeypatch.setattr(graph.common, "written", lambda spark, df, tag, path=None: (tags.append(tag), written(spark, df, tag, path))[1])
    links = spark.range(300_000).select(F.col("id").alias("a"), (F.col("id") + F.when(F.col("id") % 5 < 4, 1).otherwise(0)).alias("b"))
    found = graph.components(spark, links.repartition(7, "a"))
    assert found.agg(F.count("*"), F.count_if(F.col("root") == F.col("node") - F.col("node") % 5)).first()[:] == (240_000, 240_000)
    assert tags == ["links"]


def test_band_keys_are_compiled(spark):
    """No method with the keys of a node is longer than the 8,000 bytes beyond which the JVM interprets it; 32 keys written out were."""
    nodes = spark.range(3).select("id", F.transform(F.sequence(F.lit(0), F.lit(159)), lambda i: F.hash("id", i)).alias("whole"))
    scheme = minhash.scheme()
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    for keys in (scheme.bands, scheme.finer):
        made = debug.codegenStringSeq(nodes.select("id", F.posexplode(keys))._jdf.queryExecution().executedPlan())
        assert max(made.apply(i)._3().maxMethodCodeSize() for i in range(made.size())) < 8_000
    one = nodes.select("whole", scheme.bands.alias("bands"), scheme.finer.alias("finer")).first()
    hashes = lambda i, values: spark.range(1).select(F.xxhash64(F.lit(i), *map(F.lit, values))).first()[0]
    assert (len(one["bands"]), len(one["finer"])) == (32, 53)
    assert (one["bands"][31], one["finer"][52]) == (hashes(31, one["whole"][155:160]), hashes(52, one["whole"][156:159]))


def test_words_of_many_texts_at_once():
    """Sets are as large as those of the plain definition, and each text has the same one alone and in any batch."""
    rng = random.Random(1)
    texts = [None, "", " ", "a", "A b", "\ta  b\n", "x" * 63, "x" * 64, "x" * 65 + " " + "x" * 66, "é" * 40 + " É" * 40, "x\x00 x x\x00"]
    texts += ["".join(rng.choice(" \t\n\x0b\x0c\r\x1f\xa0aAbBzZé中\U0001f600") for _ in range(rng.randrange(200))) for _ in range(400)]

    def size(text, shingle):
        words = (text or "").encode().lower().split()
        return min(len(words), 1) if len(words) < shingle else len({tuple(words[i : i + shingle]) for i in range(len(words) - shingle + 1)})

    for shingle in (1, 2, 3):
        sets = minhash.shingle_sets(pa.array(texts), shingle)
        assert [len(s) for s in sets] == [size(t, shingle) for t in texts]
        assert all((minhash.shingle_set(t, shingle) == s).all() for t, s in zip(texts, sets))
        assert all((a == b).all() for a, b in zip(sets[7:90], minhash.shingle_sets(pa.array(texts).slice(7, 83), shingle)))
    assert minhash.shingle_sets(pa.array([], pa.string())) == []
    assert (minhash.shingle_set("AB cd ef") == minhash.shingle_set(" ab\nCD\tEF ")).all()
