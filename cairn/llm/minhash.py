"""MinHash near-duplicate groups with sequential Bayesian verification (operator 12).

A text's words are its runs between ASCII white space, A-Z lower-cased; its set
are its distinct runs of ``shingle`` words, or the whole sequence if it has
fewer.  Texts are linked when their sets have a Jaccard similarity of at least
``similarity``; a group is what links reach.

Method: ``BANDS`` x ``ROWS`` MinHash values; texts that agree in a band are
candidates.  A candidate pair's values are compared in batches of ``BATCH``.
After each one, with a uniform prior, the posterior probability that the pair is
similar enough follows from the matches so far (a beta tail, here the equal
binomial one); the pair is dropped as soon as that is below ``MISS``.  The first
batch is a sketch of one bit for each of 128 values, which travels with the
band's rows; the others are the values.  Survivors are compared exactly on their
full sets, read from their texts again, so no wrong pair is linked.  A pair at
exactly 0.8 is missed by all bands with a probability of 3e-6, by a batch with
about ``MISS``; more similar ones far more rarely.

Scale: equal sets are one node; ``bands`` connects the nodes without emitting
all pairs of a group.  Only 640 bytes of values are kept for a node, no sets.

Defined results: a text that is null, empty or blank has no shingles and is
linked with nothing; a null key takes part but is never a group's smallest;
repeated rows are all returned, and ``kept`` is true for each row whose key is
its group's smallest; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm import bands, common, graph

SHINGLE = 2
SIMILARITY = 0.8
BANDS, ROWS, BATCH = 32, 5, 32
FIRST_BANDS = 8
#: The posterior probability of being similar enough below which a pair is dropped.
MISS = 1e-6
SEED = 42
#: Values of a finer key, and how many such keys there are.
_FINER = 3
_VALUES = BANDS * ROWS
_RNG = np.random.default_rng(20250117)
_MULTIPLY = (_RNG.integers(0, 2**32, size=_VALUES, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_ADD = _RNG.integers(0, 2**32, size=_VALUES, dtype=np.uint64).astype(np.uint32)
_SPACE = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
#: Bytes of a word up to which words are hashed together, and what is read of eight bytes if fewer are a word's.
_LONG = 64
_BYTES = np.array([2 ** (8 * i) - 1 for i in range(9)], dtype=np.uint64)


def shingle_set(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    return shingle_sets(pa.array([(text or "").encode("utf-8", "surrogatepass")], pa.binary()), shingle)[0]


def shingle_sets(texts: pa.Array, shingle: int = SHINGLE) -> list[np.ndarray]:
    """``shingle_set`` of each text; words and runs are hashed for all of them at once."""
    h, count = word_hashes(texts)
    run = np.zeros(max(len(h) - shingle + 1, 0), dtype=np.uint64)
    out, first = [], 0
    with np.errstate(over="ignore"):
        for i in range(shingle):  # a word's place counts; runs that cross two texts are not taken
            run = _mixed(run + h[i : i + len(run)])
        for n in count.tolist():
            if n >= shingle:
                out.append(np.unique(run[first : first + n - shingle + 1]))
            elif n:
                own = h[first : first + n]
                out.append(np.array([_mixed(np.bitwise_xor.reduce(own * (np.arange(n, dtype=np.uint64) * np.uint64(2) + np.uint64(3))))], dtype=np.uint64))
            else:
                out.append(np.zeros(0, dtype=np.uint64))
            first += n
    return out


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts in order, and how many words each text has.

    Words of up to ``_LONG`` bytes are mixed eight bytes at a time, all together
    (up to eight bytes, words of one length never collide); longer ones by XXH64.
    """
    from xxhash import xxh64_intdigest

    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64, count=texts.offset + len(texts) + 1)[texts.offset :] if offsets is not None else np.zeros(1, dtype=np.int64)
    ends = ends - (first := int(ends[0]))
    n = int(ends[-1])
    if not n:
        return np.zeros(0, dtype=np.uint64), np.zeros(len(texts), dtype=np.int64)
    body = data[first : first + n].to_pybytes().lower() + bytes(8)
    inside = ~_SPACE[np.frombuffer(body, dtype=np.uint8, count=n)]
    edge = np.zeros(n + 1, dtype=bool)  # where a text begins or ends, or a white space does
    edge[1:n] = inside[1:] != inside[:-1]
    edge[ends] = True
    begin = np.flatnonzero(inside & edge[:n])
    size = np.flatnonzero(inside & edge[1:]) + 1 - begin
    eight = np.ndarray(n + 1, dtype="<u8", buffer=body, strides=(1,))
    with np.errstate(over="ignore"):
        h = _mixed(size.astype(np.uint64) + np.uint64(SEED))
        left = np.flatnonzero(size <= _LONG)
        for at in range(0, _LONG, 8):
            left = left[size[left] > at] if at else left
            h[left] = _mixed(h[left] ^ (eight[begin[left] + at] & _BYTES[np.minimum(size[left] - at, 8)]))
    for i in np.flatnonzero(size > _LONG).tolist():
        h[i] = xxh64_intdigest(body[begin[i] : begin[i] + size[i]], SEED)
    return h, np.diff(np.searchsorted(begin, ends))


def _mixed(z):
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def signature(h: np.ndarray) -> np.ndarray:
    """The ``BANDS`` x ``ROWS`` least values of a set under as many orders."""
    x = (h >> np.uint64(32)).astype(np.uint32) ^ h.astype(np.uint32)
    least = np.full(_VALUES, 2**32 - 1, dtype=np.uint32)
    for i in range(0, len(x), 512):
        least = np.minimum(least, (x[i : i + 512, None] * _MULTIPLY + _ADD).min(axis=0))
    return least


def sketch(values: np.ndarray) -> np.ndarray:
    """Two longs: one bit of each of the first 128 values (of each row), mixed so that equal bits of different values are chance."""
    mixed = values[..., :128] * np.uint32(0x9E3779B1)
    return np.packbits(mixed >> np.uint32(31), axis=-1, bitorder="little").view("<i8")


def _below(n: int, p: float, m: int) -> float:
    """P(Binomial(n, p) <= m)."""
    return sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(m + 1))


def posterior(matches: int, n: int, similarity: float) -> float:
    """P(similarity of the sets >= ``similarity``) after ``matches`` of ``n`` values agreed, from a uniform prior."""
    return _below(n + 1, similarity, matches)


def least_matches(n: int, similarity: float, miss: float) -> int:
    """The fewest of ``n`` matches with which a pair goes on."""
    return next(m for m in range(n + 1) if posterior(m, n, similarity) >= miss)


def most_apart(bits: int, similarity: float, miss: float) -> int:
    """The most differing one-bit values with which a pair goes on: a bit agrees with probability (1 + s) / 2, so the prior lies on [1/2, 1]."""
    agree = lambda m: _below(bits + 1, (1 + similarity) / 2, m) / max(_below(bits + 1, 0.5, m), 1e-300)
    return bits - next(m for m in range(bits + 1) if agree(m) >= miss)


def scheme(similarity: float = SIMILARITY, miss: float = MISS) -> bands.Scheme:
    limits = [(n, least_matches(n, similarity, miss)) for n in range(BATCH, _VALUES + 1, BATCH)]

    def plausible(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        left, matches = np.arange(len(a)), np.zeros(len(a), dtype=np.int64)
        for n, least in limits:  # batch by batch; only pairs that may still be similar go on
            matches = matches + (a[left, n - BATCH : n] == b[left, n - BATCH : n]).sum(axis=1)
            left, matches = left[matches >= least], matches[matches >= least]
        out = np.zeros(len(a), dtype=bool)
        out[left] = True
        return out

    def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a == b).sum(axis=1, dtype=np.int64)

    def first_shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a.reshape(-1, BANDS, ROWS) == b.reshape(-1, BANDS, ROWS)).all(axis=2).argmax(axis=1)

    def keys(count: int, width: int):
        # written out lane by lane this is one method too long for the JVM to compile
        return F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda i: F.xxhash64(i, *[F.get("whole", i * width + j) for j in range(width)]))

    return bands.Scheme(keys(BANDS, ROWS), keys(_VALUES // _FINER, _FINER), FIRST_BANDS, most_apart(128, similarity, miss), plausible, likeness, first_shared)


def _sets(texts: DataFrame, shingle: int, values: bool) -> DataFrame:
    """From (doc_id, h, text) to (doc_id, h, node, n_shingles) and the signature, or the set itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        for batch in common.sliced(batches, 2):
            sets = shingle_sets(batch.column(2), shingle)
            nodes = np.array([xxh64_intdigest(s.tobytes(), SEED) if len(s) else 0 for s in sets], dtype=np.uint64).view(np.int64)
            columns = [batch.column(0), batch.column(1), pa.array(nodes), pa.array([len(s) for s in sets], pa.int64())]
            if not values:
                yield pa.RecordBatch.from_arrays([*columns, pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["doc_id", "h", "node", "n_shingles", "shingles"])
                continue
            each = np.array([signature(s) for s in sets], dtype=np.uint32).reshape(-1, _VALUES)
            bits = sketch(each)
            whole = pa.ListArray.from_arrays(pa.array(np.arange(len(each) + 1, dtype=np.int32) * _VALUES), pa.array(each.reshape(-1).view(np.int32)))
            columns += [pa.array(bits[:, 0]), pa.array(bits[:, 1]), whole]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "h", "node", "n_shingles", "s0", "s1", "whole"])

    out = "doc_id long, h long, node long, n_shingles long, " + ("s0 long, s1 long, whole array<int>" if values else "shingles array<long>")
    return texts.mapInArrow(run, out)


def groups(
    spark: SparkSession, docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, similarity: float = SIMILARITY, miss: float = MISS, bucket: int = bands.BUCKET, few_nodes: int = 1_000_000
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row for each document."""
    common.prepare(spark)
    body = F.col(text).cast("string")
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(body).alias("h"), body.alias("text"))
    every = common.written(spark, _sets(texts, shingle, True), "minhash")
    rows = common.written(spark, every.select("doc_id", "h", "node", "n_shingles"), "minhash-rows")
    # one text stands for a node: of its rows, that with the smallest key (nulls last)
    own = F.min_by(F.struct("doc_id", "h"), F.struct(F.col("doc_id").isNull(), "doc_id", "h"))
    nodes = every.filter("n_shingles > 0").groupBy("node", "s0", "s1").agg(F.min("doc_id").alias("first"), own.alias("own"), F.max("whole").alias("whole"))
    nodes = common.written(spark, nodes, "minhash-nodes")
    common.drop(every)

    def sets(asked: DataFrame) -> DataFrame:
        wanted = common.written(spark, nodes.join(common.few(asked, few_nodes), "node", "left_semi").select(F.col("own.doc_id").alias("_doc"), F.col("own.h").alias("_h")), "wanted")
        wanted = F.broadcast(wanted) if wanted.count() <= few_nodes else wanted
        found = texts.join(wanted, [F.col("doc_id").eqNullSafe(F.col("_doc")), F.col("h") == F.col("_h")], "left_semi")
        return _sets(found, shingle, False).select("node", "shingles").dropDuplicates(["node"])

    found = bands.links(spark, nodes.select("node", "s0", "s1", "whole"), scheme(similarity, miss), sets, similarity, bucket=bucket)
    named = graph.components(spark, found)
    least = common.written(spark, _least(nodes.select("node", "first"), named), "components")
    out = rows.join(least, "node", "left").select("doc_id", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _least(nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """(node, least): the smallest key of each node's component."""
    placed = nodes.join(roots, "node", "left").select("node", "first", F.coalesce("root", "node").alias("root"))
    return placed.join(placed.groupBy("root").agg(F.min("first").alias("least")), "root").select("node", "least")
