"""Kneser-Ney perplexities against a plain dictionary implementation, and rows judged by themselves."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest

from cairn.llm import quality

WORDS = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar papa".split()


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", ".", ",", "s", ""]) for _ in range(n))


def symbols(text):
    body = re.sub(r"\s+", " ", text or "").strip(" ")
    return ["start"] * 3 + ["0" if c.isdecimal() else c if ord(c) < 0x10000 else "other" for c in body] + ["end"]


class PlainKneserNey:
    """Interpolated modified Kneser-Ney by its definition, in dictionaries of tuples."""

    def __init__(self, texts):
        top = Counter()
        for t in texts:
            s = symbols(t)
            top.update(tuple(s[i : i + 4]) for i in range(len(s) - 3))
        self.counts = {4: top}
        for n in (3, 2, 1):
            before = defaultdict(set)
            for gram in self.counts[n + 1]:
                before[gram[1:]].add(gram[0])
            self.counts[n] = {g: len(b) for g, b in before.items()}
        self.size = len({g[-1] for g in top}) + 1
        self.off, self.sums = {}, {}
        for n, counts in self.counts.items():
            have = Counter(counts.values())
            y = have[1] / max(have[1] + 2 * have[2], 1)
            d = [min(k - 0.05, max(0.05, k - (k + 1) * y * have[k + 1] / have[k])) if have[k] and have[k + 1] else k / 2 for k in (1, 2, 3)]
            self.off[n] = lambda c, d=d: d[min(c, 3) - 1]
            sums = defaultdict(lambda: [0, 0.0])
            for g, c in counts.items():
                sums[g[:-1]][0] += c
                sums[g[:-1]][1] += self.off[n](c)
            self.sums[n] = sums

    def p(self, gram):
        if not gram:
            return 1 / self.size
        n, lower = len(gram), self.p(gram[1:])
        if gram[:-1] not in self.sums[n]:
            return lower
        total, lost = self.sums[n][gram[:-1]]
        c = self.counts[n].get(gram, 0)
        return (c - self.off[n](c) if c else 0) / total + lost / total * lower

    def perplexity(self, text):
        s = symbols(text)
        logs = [math.log(self.p(tuple(s[i : i + 4]))) for i in range(len(s) - 3)]
        return math.exp(-sum(logs) / len(logs))


ROWS = [(i, prose(i, 40), "en" if i % 2 else "fr") for i in range(60)]
ROWS += [(100, None, "en"), (101, "", None), (102, "a 1\n2  é 日本 😀 <b>", "fr"), (103, prose(5, 30), "xx"), (104, "ZZ!! " * 30, "en"), (None, prose(3, 20), "en"), (55, "QQ@@ " * 20, "en"), (55, ROWS[55][1], "en")]
LABELS = [(i, 1, 0) for i in range(50)] + [(104, 0, 0)]


@pytest.mark.parametrize("table_rows", [quality.TABLE_ROWS, 0])
def test_perplexity_equals_plain_kneser_ney(spark, table_rows):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string").repartition(3)
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    counted = {r["doc_id"] for r in quality.trusted_ids(labels).filter("trusted").collect()}
    models = {lang: PlainKneserNey([t for i, t, lg in ROWS if i in counted and lg == lang]) for lang in ("en", "fr")}
    models["*"] = PlainKneserNey([t for i, t, _ in ROWS if i in counted])
    got = [(r["doc_id"], r["lang"], r["perplexity"]) for r in quality.classify(spark, docs, labels, table_rows=table_rows).collect()]
    want = [(i, lang or "und", models.get(lang, models["*"]).perplexity(t)) for i, t, lang in ROWS]
    key = lambda r: (str(r[0]), r[1], r[2])
    assert len(got) == len(want)
    for a, b in zip(sorted(got, key=key), sorted(want, key=key)):
        assert a[:2] == b[:2] and abs(a[2] - b[2]) <= 1e-9 * b[2], (a, b)


def test_both_scoring_paths_give_the_same(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string")
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    runs = [sorted((str(r["doc_id"]), r["lang"], r["keep"], r["perplexity"]) for r in quality.classify(spark, docs, labels, table_rows=n, label_rows=n).collect()) for n in (10**6, 0)]
    assert all(a[:3] == b[:3] and abs(a[3] - b[3]) <= 1e-12 * b[3] for a, b in zip(*runs))


def test_rows_are_judged_not_keys(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(50)], "doc_id long, quality int, toxic int")
    judged = quality.classify(spark, docs, labels).collect()
    for most in (10**6, 0):
        kept = quality.keep_good(spark, docs, labels, drop_rows=most)
        assert kept.columns == docs.columns and kept.count() == sum(r["keep"] for r in judged)
        assert [r["text"] for r in kept.filter("doc_id = 55").collect()] == [ROWS[55][1]] * 2
