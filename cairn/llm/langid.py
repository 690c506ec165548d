"""Language identification by hierarchical discrimination (operator 9).

Whole texts are described by their letter n-grams (orders 1 to 3, hashed,
square-rooted shares).  First one-versus-rest linear support vector machines
pick the language family; then one-versus-one machines separate the languages
inside it by votes.  Families come from a table; a language that it lacks is a
family of its own.

Scale: the machines are fitted on the driver from at most ``FIT_DOCS`` texts of
each language (a bounded, documented sample: those with the smallest id
hashes), whose features are computed on the executors.  Prediction is one
narrow pass over all texts and shuffles nothing.

Defined results: null text or text without a letter is ``und`` with score 0, as
is every text when nothing can be learned; null doc_ids are carried (and count
as held in); repeated rows are each returned; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairn.llm import common

FIT_DOCS = 200
ORDERS = (1, 2, 3)
BITS = 12
BLOCK_CHARS = 1 << 20

# Families of closely related languages, by ISO 639-1 code.
FAMILIES = {
    "germanic": ("de", "en", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "lb", "fy"),
    "romance": ("es", "fr", "it", "pt", "ro", "ca", "gl", "oc", "la"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "bs", "sl", "mk"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz", "ky"),
    "indic": ("hi", "mr", "ne", "bn", "ur", "gu", "pa"),
    "sinitic": ("zh",),
    "semitic": ("ar", "he", "am", "mt"),
}
_FAMILY_OF = {lang: family for family, langs in FAMILIES.items() for lang in langs}
_LETTER: np.ndarray | None = None


def family_of(lang: str) -> str:
    return _FAMILY_OF.get(lang.lower().split("-")[0].split("_")[0], f"other:{lang}")


def _letters() -> np.ndarray:
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)
    return _LETTER


def features(text: str | None) -> np.ndarray | None:
    """The text's feature vector (float32), or None if it has no letter."""
    counts = np.zeros((len(ORDERS), 1 << BITS), dtype=np.float64)
    any_letter = False
    text = text or ""
    for at in range(0, len(text), BLOCK_CHARS):  # whole text, in blocks of bounded memory
        codes = np.frombuffer(text[at : at + BLOCK_CHARS].lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        letter = _letters()[codes]
        any_letter |= bool(letter.any())
        codes = np.where(letter, codes, 32)
        keep = np.concatenate(([True], letter[1:] | letter[:-1]))  # a run of other characters is one space
        codes = codes[keep].astype(np.uint64)
        with np.errstate(over="ignore"):
            h = np.zeros(len(codes), dtype=np.uint64)
            for row, n in enumerate(ORDERS):
                if len(codes) < n:
                    break
                h = h[: len(codes) - n + 1] * np.uint64(0x100000001B3) + codes[n - 1 :] + np.uint64(1)
                counts[row] += np.bincount(((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int64), minlength=1 << BITS)
    if not any_letter:
        return None
    x = np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)).ravel()
    return (x / np.sqrt(len(ORDERS))).astype(np.float32)


def fit_svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, rounds: int = 25, seed: int = 3) -> np.ndarray:
    """Weights of a linear SVM (squared hinge, dual coordinate descent); the last one is the bias."""
    x = np.hstack((x, np.ones((len(x), 1), dtype=np.float32))).astype(np.float64)
    w, a = np.zeros(x.shape[1]), np.zeros(len(x))
    n_pos = max(1, int((y > 0).sum()))
    n_neg = max(1, int((y < 0).sum()))
    diag = np.where(y > 0, n_pos, n_neg) / (c * len(y))  # both sides weigh the same
    squares = (x**2).sum(axis=1) + diag
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        for i in rng.permutation(len(x)):
            new = max(0.0, a[i] - (y[i] * (w @ x[i]) - 1 + diag[i] * a[i]) / squares[i])
            if new != a[i]:
                w += (new - a[i]) * y[i] * x[i]
                a[i] = new
    return w


class Hierarchy:
    """Family machines, and for each family a machine for each pair of its languages."""

    def __init__(self, x: np.ndarray, langs: list[str]):
        labels = np.array(langs)
        self.families = sorted({family_of(lang) for lang in langs})
        family = np.array([family_of(lang) for lang in langs])
        self.members = {f: sorted(set(labels[family == f].tolist())) for f in self.families}
        self.top = np.stack([fit_svm(x, np.where(family == f, 1.0, -1.0)) for f in self.families]) if len(self.families) > 1 else None
        self.pairs = {}
        for f, members in self.members.items():
            for a, b in combinations(members, 2):
                rows = (labels == a) | (labels == b)
                self.pairs[f, a, b] = fit_svm(x[rows], np.where(labels[rows] == a, 1.0, -1.0))

    def predict(self, x: np.ndarray) -> tuple[str, float]:
        family, sure = self.families[0], 1.0
        if self.top is not None:
            margins = self.top[:, :-1] @ x + self.top[:, -1]
            best = int(margins.argmax())
            odds = np.exp(3 * (margins - margins[best]))
            family, sure = self.families[best], float(1 / odds.sum())
        members = self.members[family]
        votes, trust = dict.fromkeys(members, 0.0), dict.fromkeys(members, 1.0)
        for a, b in combinations(members, 2):
            w = self.pairs[family, a, b]
            p = float(1 / (1 + np.exp(-np.clip(3 * (w[:-1] @ x + w[-1]), -50, 50))))
            votes[a if p >= 0.5 else b] += 1 + 1e-6 * abs(p - 0.5)
            trust[a] = min(trust[a], p)
            trust[b] = min(trust[b], 1 - p)
        lang = max(members, key=lambda m: (votes[m], m))
        return lang, min(1.0, max(0.0, sure * trust[lang]))


def held_out(key: str = "doc_id"):
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string")), F.lit(5)) == 0, F.lit(False))


def learn(spark: SparkSession, docs: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang", fit_docs: int = FIT_DOCS) -> Hierarchy | None:
    """Fit on documents that are not held out and have a language; ``fit_docs`` of each at most."""
    common.prepare(spark)
    known = docs.filter(~held_out(key) & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.xxhash64(F.col(key), F.length(text)).alias("h"), F.col(text).alias("text"))
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}  # a row per language
    if not counts:
        return None
    # three times the wanted number by a hash bound first, so that no language's whole text is sorted
    bound = F.create_map(*[F.lit(v) for lang_, n in sorted(counts.items()) for v in (lang_, min(1.0, (3 * fit_docs + 60) / n))])
    some = known.filter(F.pmod("h", F.lit(1 << 20)) < bound[F.col("lang")] * (1 << 20))
    ranked = some.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).filter(F.col("n") <= fit_docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(lang_, x.astype(np.float16).tobytes()) for lang_, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if (x := features(t)) is not None]
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.string()), pa.array([b for _, b in found], pa.binary())], ["lang", "x"])

    rows = sorted((r["lang"], bytes(r["x"])) for r in ranked.select("lang", "text").mapInArrow(run, "lang string, x binary").collect())
    if not rows:
        return None
    return Hierarchy(np.stack([np.frombuffer(x, dtype=np.float16) for _, x in rows]).astype(np.float32), [lang_ for lang_, _ in rows])


def predict(spark: SparkSession, docs: DataFrame, model: Hierarchy | None, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    common.prepare(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in common.sliced(batches, 2):
            found = [model.predict(x) if model is not None and (x := features(t)) is not None else ("und", 0.0) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([a for a, _ in found], pa.string()), pa.array([b for _, b in found], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), held_out(key).alias("held_out"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def identify(spark: SparkSession, docs: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang", fit_docs: int = FIT_DOCS) -> DataFrame:
    return predict(spark, docs, learn(spark, docs, key=key, text=text, lang=lang, fit_docs=fit_docs), key=key, text=text)
