"""Quality classifier (operator 7): interpolated modified Kneser-Ney perplexity.

A character 4-gram model for each language is counted over the trusted
documents (labelled quality 1) of four folds of five; the fifth fold, which the
model has not seen, sets the threshold, so unlabelled text is measured alike.
Modified Kneser-Ney uses three discounts for each order, estimated from the
counts of counts, continuation counts below the highest order, and
interpolation down to a uniform distribution.  Every
distinct 4-gram of the whole corpus is joined with the counts, so its log
probability is computed once, and a document's perplexity comes from the sum
over its 4-grams.  A document is kept when its perplexity is at most the
``QUANTILE`` of that fold's documents in its language (``percentile_approx``,
whose rank is off by at most one in ``ACCURACY`` of the fold).

Text is taken whole: runs of white space are one space, digits are one symbol,
characters beyond the basic plane are one symbol; three start marks go before.
A 4-gram is one long of four 16-bit characters, so orders and contexts are
shifts and masks of the same key.

Scale: tasks reduce their texts to distinct (language, 4-gram) counts before
the shuffle; the count joins are hash-sharded by key.  The probability table is
handed to the scoring tasks only if it has at most ``TABLE_ROWS`` rows (counted
first); a larger one is joined with the documents' own 4-gram counts instead,
with the same double-precision probabilities.
Labels are broadcast below ``LABEL_ROWS`` (counted), else joined by shuffle.

Defined results: null or empty text scores on its end mark alone; a null
language is a language of its own ("und"); a language without trusted
documents is scored with all languages' counts ("*") and their quantile; with
no trusted document to count, perplexity is null and everything is kept, as it
is when the threshold's fold is empty; null
keys are carried (never trusted); repeated documents are each scored; repeated
labels count once, as trusted only if none of them has quality 0; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm import common

ORDER = 4
#: One trusted document in a hundred is given up for what lies above it.
QUANTILE = 0.99
ACCURACY = 10_000
FOLDS = 5
TABLE_ROWS = 4_000_000
LABEL_ROWS = 1_000_000
BLOCK_CHARS = 1 << 20
_SPACE = re.compile(r"\s+")
_START, _END, _OTHER = 2, 3, 0xFFFF
_DIGIT = np.zeros(0x10000, dtype=bool)
_DIGIT[[c for c in range(0x10000) if chr(c).isdecimal()]] = True
_LOW48 = (1 << 48) - 1


def keys_of(text: str | None) -> np.ndarray:
    """The whole text's 4-grams as signed longs, the last one ending in the end mark."""
    body = _SPACE.sub(" ", text or "").strip(" ")
    codes = np.frombuffer(body.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = np.where(codes > 0xFFFF, _OTHER, codes)
    codes = np.where(_DIGIT[codes], ord("0"), codes)
    codes = np.concatenate(([_START] * (ORDER - 1), codes, [_END])).astype(np.uint64)
    keys = codes[3:] | codes[2:-1] << np.uint64(16) | codes[1:-2] << np.uint64(32) | codes[:-3] << np.uint64(48)
    return keys.view(np.int64)


class _Counts:
    """Distinct keys with counts of trusted and other text, for each language of a task."""

    def __init__(self):
        self.parts: dict[str, list] = {}
        self.rows = 0
        self.most = 1_000_000  # rows before a merge

    def add(self, lang: str, keys: np.ndarray, trusted: bool) -> None:
        u, n = np.unique(keys, return_counts=True)
        self.parts.setdefault(lang, []).append((u, n * trusted))
        self.rows += len(u)
        if self.rows > self.most:
            self.merge()
            self.most = max(self.most, 2 * self.rows)

    def merge(self) -> None:
        self.rows = 0
        for lang, parts in self.parts.items():
            k, t = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            u, where = np.unique(k, return_inverse=True)
            self.parts[lang] = [(u, np.bincount(where, weights=t, minlength=len(u)).astype(np.int64))]
            self.rows += len(u)

    def batches(self) -> Iterator[pa.RecordBatch]:
        self.merge()
        for lang, [(u, t)] in self.parts.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(u), pa.string()), pa.array(u), pa.array(t)], ["lang", "key", "c"])


def gather(docs: DataFrame) -> DataFrame:
    """``docs(lang, text, trusted)`` -> (lang, key, c): every distinct 4-gram of the corpus and its count in trusted text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, waiting, chars = _Counts(), {}, 0

        def flush():
            for (lang, trusted), keys in waiting.items():
                counts.add(lang, np.concatenate(keys), trusted)
            waiting.clear()

        for batch in common.sliced(batches, 1):
            for lang, text, trusted in zip(*(batch.column(i).to_pylist() for i in range(3))):
                keys = keys_of(text)
                waiting.setdefault((lang, trusted), []).append(keys)
                chars += len(keys)
                if chars > BLOCK_CHARS:
                    flush()
                    chars = 0
        flush()
        yield from counts.batches()

    each = docs.select("lang", "text", "trusted").mapInArrow(run, "lang string, key long, c long")
    return each.groupBy("lang", "key").agg(F.sum("c").alias("c"))


def levels(model: DataFrame) -> DataFrame:
    """Of the model's 4-grams (lang, key, c): (lang, w, key, c) for every order ``w``, 4 to 1.

    Below the highest order ``c`` is the continuation count, how many different
    symbols stand before ``key``: one pass that lists each 4-gram's shorter
    endings with the symbol before them, and counts the distinct ones.
    """
    ends = F.array(*[F.struct(F.lit(w).alias("w"), F.col("key").bitwiseAND(F.lit((1 << 16 * w) - 1).cast("long")).alias("key"), F.col("key").bitwiseAND(F.lit((1 << 16 * (w + 1)) - 1 if w < 3 else -1).cast("long")).alias("longer")) for w in (3, 2, 1)])
    lower = model.select("lang", F.explode(ends).alias("e")).select("lang", "e.*").distinct().groupBy("lang", "w", "key").agg(F.count("*").alias("c"))
    return model.select("lang", F.lit(ORDER).alias("w"), "key", "c").unionByName(lower)


def discounts(counts: DataFrame) -> DataFrame:
    """(lang, w, d1, d2, d3): the three discounts of each language and order, from its counts of counts."""
    of = counts.groupBy("lang", "w").agg(*[F.count_if(F.col("c") == n).cast("double").alias(f"n{n}") for n in (1, 2, 3, 4)])
    y = F.col("n1") / F.greatest(F.col("n1") + 2 * F.col("n2"), F.lit(1.0))
    steps = [("n1", "n2", 1), ("n2", "n3", 2), ("n3", "n4", 3)]
    # an order with no counts of counts to estimate from takes the usual 0.5, 1 and 1.5
    return of.select("lang", "w", *[F.when((F.col(a) > 0) & (F.col(b) > 0), F.greatest(F.lit(0.05), F.least(F.lit(k - 0.05), k - (k + 1) * y * F.col(b) / F.col(a)))).otherwise(k / 2).alias(f"d{k}") for a, b, k in steps])


def _context(key: str, w: str):
    """The symbols before the last one of a key of order ``w``, of which one has none."""
    return F.when(F.col(w) > 1, F.shiftrightunsigned(key, 16)).otherwise(F.lit(0).cast("long"))


def tables(spark: SparkSession, model: DataFrame) -> DataFrame:
    """(lang, w, kind, key, v): discounted shares (kind 0, by key) and back-off weights (kind 1, by context)."""
    counts = common.written(spark, levels(model), "levels")
    off = common.few(common.written(spark, discounts(counts), "discounts"))  # a row for each language and order
    rows = counts.join(off, ["lang", "w"]).withColumn("h", _context("key", "w"))
    off = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
    rows = rows.withColumn("off", off)
    sums = rows.groupBy("lang", "w", "h").agg(F.sum("c").cast("double").alias("total"), F.sum("off").alias("lost"))
    shares = rows.join(sums, ["lang", "w", "h"]).select("lang", "w", F.lit(0).alias("kind"), "key", ((F.col("c") - F.col("off")) / F.col("total")).alias("v"))
    return common.written(spark, shares.unionByName(sums.select("lang", "w", F.lit(1).alias("kind"), F.col("h").alias("key"), (F.col("lost") / F.col("total")).alias("v"))), "tables")


def probabilities(spark: SparkSession, gathered: DataFrame) -> DataFrame:
    """(lang, key, logp) for every distinct 4-gram of the corpus, by joins sharded by key.

    Every asked 4-gram looks up its share and its context's weight at each
    order: eight rows of one join, brought together again by 4-gram.
    """
    trusted = gathered.filter("c > 0")
    pooled = trusted.groupBy("key").agg(F.sum("c").alias("c")).select(F.lit("*").alias("lang"), "key", "c")
    model = common.written(spark, trusted.unionByName(pooled), "trusted")
    size = model.select("lang", F.col("key").bitwiseAND(F.lit(0xFFFF).cast("long")).alias("w")).distinct().groupBy("lang").agg((F.count("*") + 1).cast("double").alias("v"))
    known = common.few(common.written(spark, trusted.select("lang").distinct(), "known"))
    alone = gathered.join(known, "lang", "left_anti").select("key").distinct()  # of languages that can't be learned
    asked = gathered.join(known, "lang", "left_semi").select("lang", "key").unionByName(alone.select(F.lit("*").alias("lang"), "key"))
    masked = [(w, F.col("key").bitwiseAND(F.lit((1 << 16 * w) - 1 if w < ORDER else -1).cast("long"))) for w in range(1, ORDER + 1)]
    wanted = [F.struct(F.lit(w).alias("w"), F.lit(0).alias("kind"), k.alias("k")) for w, k in masked]
    wanted += [F.struct(F.lit(w).alias("w"), F.lit(1).alias("kind"), (F.shiftrightunsigned(k, 16) if w > 1 else F.lit(0).cast("long")).alias("k")) for w, k in masked]
    each = asked.select("lang", F.col("key").alias("gram"), F.explode(F.array(*wanted)).alias("e")).select("lang", "gram", "e.w", "e.kind", F.col("e.k").alias("key"))
    found = each.join(tables(spark, model), ["lang", "w", "kind", "key"], "left")
    pick = lambda w, kind, none: F.coalesce(F.max(F.when((F.col("w") == w) & (F.col("kind") == kind), F.col("v"))), F.lit(none))
    # a share that was never seen is nothing; a context that was never seen passes its whole weight on
    cells = [pick(w, kind, none).alias(f"{name}{w}") for w in range(1, ORDER + 1) for kind, name, none in ((0, "a", 0.0), (1, "g", 1.0))]
    rows = found.groupBy("lang", "gram").agg(*cells).join(common.few(common.written(spark, size, "sizes")), "lang")  # a row for each language
    p = 1 / F.col("v")
    for w in range(1, ORDER + 1):
        p = F.col(f"a{w}") + F.col(f"g{w}") * p
    return rows.select("lang", F.col("gram").alias("key"), F.log(p).alias("logp"))


def trusted_ids(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    return labels.filter(F.col(key).isNotNull()).groupBy(F.col(key).cast("long").alias("doc_id")).agg(F.min("quality").alias("q")).filter("q = 1").select("doc_id", (F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)) != 0).alias("trusted"))


class _Table:
    """Log probabilities by language, for the scoring tasks."""

    def __init__(self, rows: pa.Table):
        self.by_lang: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        langs = rows.column("lang").combine_chunks().dictionary_encode() if rows.num_rows else None
        if langs is not None:
            langs = langs.combine_chunks() if isinstance(langs, pa.ChunkedArray) else langs
            codes, keys, logp = langs.indices.to_numpy(), rows.column("key").to_numpy(), rows.column("logp").to_numpy()
            for number, lang in enumerate(langs.dictionary.to_pylist()):
                own = codes == number
                order = np.argsort(keys[own])
                self.by_lang[lang] = (keys[own][order], logp[own][order])

    def score(self, lang: str, text: str | None) -> tuple[float, int]:
        keys, logp = self.by_lang[lang if lang in self.by_lang else "*"]
        mine = keys_of(text)
        return float(logp[np.searchsorted(keys, mine)].sum()), len(mine)


def _score(spark: SparkSession, base: DataFrame, table: DataFrame, known: DataFrame, table_rows: int) -> DataFrame:
    """(row, doc_id, lang, h, trusted, total, n) for every document: its log probability and number of 4-grams.

    ``trusted``: true for the model's fold, false for the threshold's, null for the rest.
    """
    schema = "row long, doc_id long, lang string, h long, trusted boolean, total double, n long"
    names = [x.split()[0] for x in schema.split(", ")]
    own = base.select("row", "doc_id", "lang", "h", "trusted", "text")
    if table.count() <= table_rows:
        shared = spark.sparkContext.broadcast(_Table(table.toArrow()))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in common.sliced(batches, 5):
                found = [shared.value.score(lang, t) for lang, t in zip(batch.column(2).to_pylist(), batch.column(5).to_pylist())]
                yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array([a for a, _ in found], pa.float64()), pa.array([n for _, n in found], pa.int64())], names)

        return own.mapInArrow(run, schema)

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.sliced(batches, 5):
            for at in range(batch.num_rows):
                u, n = np.unique(keys_of(batch.column(5)[at].as_py()), return_counts=True)
                cells = [pa.array([batch.column(i)[at].as_py()] * len(u), batch.column(i).type) for i in range(5)]
                yield pa.RecordBatch.from_arrays([*cells, pa.array(u), pa.array(n)], [*names[:5], "key", "n"])

    each = own.mapInArrow(grams, "row long, doc_id long, lang string, h long, trusted boolean, key long, n long")
    each = each.join(known.withColumn("model", F.col("lang")), "lang", "left").withColumn("model", F.coalesce("model", F.lit("*")))
    joined = each.join(table.withColumnRenamed("lang", "model"), ["model", "key"])
    return joined.groupBy(*names[:5]).agg(F.sum(F.col("logp") * F.col("n")).alias("total"), F.sum("n").alias("n"))


def _judged(spark: SparkSession, docs: DataFrame, labels: DataFrame, key: str, text: str, lang: str, quantile: float, table_rows: int, label_rows: int) -> DataFrame:
    """(doc_id, lang, h, perplexity, threshold, keep); ``h`` tells texts of one key and language apart."""
    common.prepare(spark)
    trusted = common.written(spark, trusted_ids(labels), "trusted-ids")
    small = trusted.count() <= label_rows
    body = F.col(text).cast("string")
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.xxhash64(body).alias("h"), body.alias("text"))
    base = rows.join(F.broadcast(trusted) if small else trusted, "doc_id", "left")  # trusted: null if not labelled so
    gathered = common.written(spark, gather(base.withColumn("trusted", F.coalesce("trusted", F.lit(False)))), "gathered")
    known = gathered.filter("c > 0").select("lang").distinct()
    if known.isEmpty():
        null = F.lit(None).cast("double")
        return rows.select("doc_id", "lang", "h", null.alias("perplexity"), null.alias("threshold"), F.lit(True).alias("keep"))
    table = common.written(spark, probabilities(spark, gathered), "probabilities")
    scored = _score(spark, base.withColumn("row", F.monotonically_increasing_id()), table, known, table_rows)
    scored = common.written(spark, scored.select("doc_id", "lang", "h", "trusted", F.exp(-F.col("total") / F.col("n")).alias("perplexity")), "scored")
    good = scored.filter("NOT trusted")
    at = F.percentile_approx("perplexity", quantile, ACCURACY)
    limits = good.groupBy("lang").agg(at.alias("own"))
    overall = good.agg(at.alias("threshold")).first()["threshold"]
    limits = common.few(common.written(spark, limits, "limits"))  # a row for each language
    judged = scored.join(limits, "lang", "left").withColumn("threshold", F.coalesce("own", F.lit(overall).cast("double")))
    return judged.select("doc_id", "lang", "h", "perplexity", "threshold", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)).alias("keep"))


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang", quantile: float = QUANTILE, table_rows: int = TABLE_ROWS, label_rows: int = LABEL_ROWS) -> DataFrame:
    """(doc_id, lang, perplexity, threshold, keep) for every document."""
    return _judged(spark, docs, labels, key, text, lang, quantile, table_rows, label_rows).drop("h")


def keep_good(spark: SparkSession, docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang", quantile: float = QUANTILE, table_rows: int = TABLE_ROWS, label_rows: int = LABEL_ROWS, drop_rows: int = LABEL_ROWS) -> DataFrame:
    """The documents that the classifier keeps, in their own columns.

    Rows are judged, not keys: a bad text goes alone when its key stands in
    other rows too, and rows with a null key are judged like any other.
    """
    judged = common.written(spark, _judged(spark, docs, labels, key, text, lang, quantile, table_rows, label_rows), "judged")
    return common.without_rows(docs, judged.filter("NOT keep").select("doc_id", "lang", "h"), {"doc_id": F.col(key).cast("long"), "lang": F.coalesce(F.col(lang).cast("string"), F.lit("und")), "h": F.xxhash64(F.col(text).cast("string"))}, drop_rows)
