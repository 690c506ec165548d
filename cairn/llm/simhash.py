"""SimHash near-duplicate groups (operator 10).

A text's words are its runs between ASCII white space, A-Z lower-cased; its
shingles are space-joined runs of ``shingle`` words, repeats included.  A bit of
the fingerprint is set when more than half of the shingles' XXH64 values (seed
42) have it.  Fingerprints that differ in at most ``radius`` bits are linked.

Method: pivot distance tables.  Every fingerprint's Hamming distances to fixed
reference fingerprints are computed once per batch; the largest difference of
two rows' entries is a lower bound of their distance, so a pair beyond the
radius in any coordinate is discarded, and only survivors are compared.

Which pairs are looked at: fingerprints within ``radius`` agree in at least one
of ``radius + 1`` bit groups, so rows are dealt by each group's value.  A group
with more than ``BUCKET`` distinct fingerprints is dealt again by a quarter of
its remaining bits, which loses no pair, until all groups fit; the fixed bits
bound their size.  Equal fingerprints are one row throughout, buckets give a
spanning forest instead of all pairs, and components come from ``graph``.

Defined results: null or empty text has fingerprint zero; a null key takes part
but is never a group's smallest; repeated rows are all returned; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm import bands, common, graph
from cairn.llm.bands import BUCKET, pivot_table

SHINGLE = 3
RADIUS = 3
SEED = 42
_BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit fingerprint of one whole text."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        return xxh64_intdigest(b" ".join(words), SEED)
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    n = len(words) - shingle + 1
    h = np.fromiter((xxh64_intdigest(g, SEED) for g in grams), dtype="<u8", count=n)
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, n, _BLOCK):
        counts += np.unpackbits(h[i : i + _BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, h, fp): the text's hash and its fingerprint, as signed longs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.sliced(batches, 1):
            fps = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(fps.view(np.int64))], ["doc_id", "h", "fp"])

    return _texts(docs, key, text).mapInArrow(run, "doc_id long, h long, fp long")


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc_id, text, h); ``h`` tells different texts of one key apart."""
    body = F.col(text).cast("string")
    return docs.select(F.col(key).cast("long").alias("doc_id"), body.alias("text"), F.xxhash64(body).alias("h"))


def _near(fps, table, one, rest, radius):
    """Which of ``rest`` are within radius of row(s) ``one``: pivots first, then the bits themselves."""
    rest = np.asarray(rest)
    apart = np.abs(table[rest] - table[one]).max(axis=1)
    ok = np.flatnonzero(apart <= radius)
    left = fps[rest[ok]] ^ (fps[one[ok]] if isinstance(one, np.ndarray) else fps[one])
    return ok[np.bitwise_count(left) <= radius]


def _bucket_links(group: np.ndarray, fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links inside each group; rows of a group are adjacent."""
    table = pivot_table(fps)
    starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    sizes = np.diff(np.concatenate((starts, [len(group)])))
    parent: dict[int, int] = {}
    links: list[tuple[int, int]] = []

    def find(x: int) -> int:
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[p]
        return x

    small = np.repeat(sizes <= 48, sizes)
    last = np.repeat(starts + sizes, sizes)
    for lag in range(1, 48):
        i = np.flatnonzero(small & (np.arange(len(group)) + lag < last))
        if not len(i):
            break
        hit = _near(fps, table, i, i + lag, radius)
        for x in i[hit].tolist():
            a, b = find(x), find(x + lag)
            if a != b:
                parent[b] = a
                links.append((x, x + lag))
    for s, n in zip(starts[sizes > 48].tolist(), sizes[sizes > 48].tolist()):
        todo = np.arange(s, s + n)
        while len(todo):
            front, todo = [int(todo[0])], todo[1:]
            while front and len(todo):
                x = front.pop()
                hit = _near(fps, table, x, todo, radius)
                links += [(x, y) for y in todo[hit].tolist()]
                front += todo[hit].tolist()
                todo = np.delete(todo, hit)
    return links


def _parts(mask: int, radius: int) -> list[int]:
    """The next masks: ``mask`` plus each of radius + 1 groups of the bits it leaves free."""
    free = [b for b in range(64) if not mask >> b & 1]
    cuts = [round(i * len(free) / (radius + 1)) for i in range(radius + 2)]
    masks = [mask | sum(1 << b for b in free[a:z]) for a, z in zip(cuts, cuts[1:]) if z > a]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(spark: SparkSession, distinct: DataFrame, *, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that connect whatever is within ``radius``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(mask, value, fp):
            group = np.concatenate(([0], np.cumsum((mask[1:] != mask[:-1]) | (value[1:] != value[:-1])))) if len(fp) else fp
            found = _bucket_links(group, fp.view(np.uint64), radius) if len(fp) else []
            a = fp[[x for x, _ in found]] if found else fp[:0]
            b = fp[[y for _, y in found]] if found else fp[:0]
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        held = [np.zeros(0, dtype=np.int64)] * 3
        for batch in batches:
            now = [np.concatenate((h, batch.column(i).to_numpy())) for i, h in enumerate(held)]
            if not len(now[0]):
                continue
            changed = np.flatnonzero((now[0] != now[0][-1]) | (now[1] != now[1][-1]))
            cut = changed[-1] + 1 if len(changed) else 0  # the last group may go on in the next batch
            yield out(*(x[:cut] for x in now))
            held = [x[cut:] for x in now]
        yield out(*held)

    found: DataFrame | None = None
    todo, masks, first = distinct.select("fp", F.lit(0).cast("long").alias("mask")), [0], True
    while True:
        child = {m: _parts(m & (2**64 - 1), radius) for m in masks}
        if first:
            nexts = F.array(*[F.lit(m).cast("long") for m in child[0]])
        else:
            pairs = spark.createDataFrame([(m, c) for m, c in child.items()], "mask long, nexts array<long>")  # 4 ** level rows
            todo = todo.join(F.broadcast(pairs), "mask")
            nexts = F.col("nexts")
        rows = todo.select("fp", F.explode(nexts).alias("mask")).select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("value"))
        sizes = rows.groupBy("mask", "value").count()
        large = common.written(spark, sizes.filter(F.col("count") > bucket).drop("count"), "large")
        masks = sorted({r["mask"] for r in large.select("mask").distinct().collect()})
        fit = rows.join(large, ["mask", "value"], "left_anti") if masks else rows
        dealt = fit.repartition("mask", "value").sortWithinPartitions("mask", "value").select("mask", "value", "fp")
        some = common.written(spark, dealt.mapInArrow(run, "a long, b long"), "near")
        found = some if found is None else found.unionByName(some)
        if not masks:
            return found
        todo, first = rows.join(large, ["mask", "value"], "left_semi").select("fp", "mask"), False


def _groups(spark: SparkSession, docs: DataFrame, key: str, text: str, shingle: int, radius: int) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, h, node), the node being the fingerprint, and (node, root, component_id)."""
    rows = common.written(spark, fingerprints(docs, key=key, text=text, shingle=shingle).withColumnRenamed("fp", "node"), "fingerprints")
    distinct = common.written(spark, rows.groupBy("node").agg(F.min("doc_id").alias("first")), "distinct")
    roots = graph.components(spark, links(spark, distinct.withColumnRenamed("node", "fp"), radius=radius))
    return rows, common.written(spark, _named(distinct, roots), "components")


def groups(spark: SparkSession, docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id): the smallest doc_id reachable over links, itself included."""
    common.prepare(spark)
    rows, each = _groups(spark, docs, key, text, shingle, radius)
    return rows.join(each, "node").select("doc_id", F.col("node").alias("fp"), "component_id")


def _named(distinct: DataFrame, roots: DataFrame) -> DataFrame:
    """(node, root, component_id) for ``distinct(node, first)``: the least ``first`` of each component."""
    nodes = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    named = nodes.join(distinct, "node")
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    linked = named.join(least, "root").select("node", "root", "component_id")
    return distinct.join(linked, "node", "left").select("node", F.coalesce("root", "node").alias("root"), F.coalesce("component_id", "first").alias("component_id"))


# ---- similar texts: wide fingerprints -------------------------------------------------------------

WIDE_SHINGLE = 5
SIMILARITY = 0.8
WORDS = 16
#: Words whose quarters the first round of candidates looks at; the second one looks at all.
FIRST_WORDS = 4
#: Standard deviations that a pair of just the wanted similarity may be off in the first two words.
_SLACK = 2.6
_STEPS = np.uint64(0x9E3779B97F4A7C15) * np.arange(1, WORDS + 1, dtype=np.uint64)


#: The same for whole fingerprints, which only spare exact comparisons.
_WHOLE_SLACK = 3.0


def shingle_set(text: str | None, shingle: int = WIDE_SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    n = max(1, len(words) - shingle + 1)
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    return np.unique(np.fromiter((xxh64_intdigest(g, SEED) for g in grams), dtype=np.uint64, count=n))


def wide_fingerprint(h: np.ndarray) -> np.ndarray:
    """``WORDS`` 64-bit SimHash words over a set of shingles, each with hashes of its own."""
    counts = np.zeros(64 * WORDS, dtype=np.int64)
    with np.errstate(over="ignore"):
        for i in range(0, len(h), 240):  # sums of at most 240 bits fit a byte
            z = h[i : i + 240, None] + _STEPS[None, :]
            z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            z ^= z >> np.uint64(31)
            bits = np.unpackbits(np.ascontiguousarray(z).view(np.uint8).reshape(len(z), -1), axis=1, bitorder="little")
            counts += np.add.reduce(bits, axis=0, dtype=np.uint8)
    return np.packbits(2 * counts > len(h), bitorder="little").view("<u8").astype(np.uint64)


def wide_radius(similarity: float, bits: int, slack: float) -> int:
    """Differing bits to expect of two sets of that Jaccard similarity, plus ``slack`` standard deviations."""
    p = float(np.arccos(2 * similarity / (1 + similarity)) / np.pi)
    return int(bits * p + slack * (bits * p * (1 - p)) ** 0.5)


def _wide_rows(docs: DataFrame, key: str, text: str, shingle: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.sliced(batches, 1):
            sets = [shingle_set(t, shingle) for t in batch.column(1).to_pylist()]
            words = [wide_fingerprint(h).view(np.int64) for h in sets]
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(words, longs), pa.array([h.view(np.int64) for h in sets], longs)], ["doc_id", "h", "words", "shingles"])

    return _texts(docs, key, text).mapInArrow(run, "doc_id long, h long, words array<long>, shingles array<long>")


def _scheme(similarity: float, whole_slack: float) -> bands.Scheme:
    """Lanes: the 16-bit quarters of all words; a pair of similarity 0.8 shares one of the 64 with a probability of over 0.99.

    Finer keys: two bytes of each word, of which such a pair shares one with a
    probability of over 0.9999.
    """
    whole_radius = wide_radius(similarity, 64 * WORDS, whole_slack)

    def keys(shifts: tuple[int, ...], width: int):
        sub = f"array({', '.join(map(str, shifts))})"
        each = f"transform({sub}, (s, i) -> (shiftrightunsigned(x, s) & {2**width - 1}) | shiftleft(cast(w * {len(shifts)} + i as bigint), {width}))"
        return F.expr(f"flatten(transform(whole, (x, w) -> {each}))")

    def plausible(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.bitwise_count((a ^ b).view(np.uint64)).sum(axis=1) <= whole_radius

    def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return -np.bitwise_count((a ^ b).view(np.uint64)).sum(axis=1, dtype=np.int64)

    def first_shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return ((a ^ b).view(np.uint16) == 0).argmax(axis=1)

    return bands.Scheme(keys((0, 16, 32, 48), 16), keys((8, 40), 8), 4 * FIRST_WORDS, wide_radius(similarity, 128, _SLACK), plausible, likeness, first_shared)


def similar_links(spark: SparkSession, distinct: DataFrame, *, similarity: float = SIMILARITY, bucket: int = BUCKET, sets: DataFrame | None = None, set_rows: int = 1_000_000) -> DataFrame:
    """Links (a, b) of ``node`` that connect texts of at least that similarity; how they are found is said in ``bands``.

    ``distinct``: (node, s0, s1, words), s0 and s1 the first two words.
    ``sets``: (node, shingles), whose exact Jaccard similarity decides; without
    it the distance of whole fingerprints does, about as well as it can.
    """

    def own(asked: DataFrame) -> DataFrame:
        if asked.count() <= set_rows:
            return sets.join(F.broadcast(asked), "node", "left_semi").dropDuplicates(["node"])
        return sets.dropDuplicates(["node"]).join(asked, "node", "left_semi")

    nodes = distinct.select("node", "s0", "s1", F.col("words").alias("whole"))
    return bands.links(spark, nodes, _scheme(similarity, 1.0 if sets is None else _WHOLE_SLACK), own if sets is not None else None, similarity, bucket=bucket)



def _similar(spark: SparkSession, docs: DataFrame, key: str, text: str, shingle: int, similarity: float) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, h, node), the node being the shingle set, and (node, root, component_id)."""
    rows = _wide_rows(docs, key, text, shingle).select(F.xxhash64("shingles").alias("node"), "doc_id", "h", F.col("words")[0].alias("s0"), F.col("words")[1].alias("s1"), "words", "shingles")
    rows = common.written(spark, rows, "wide")
    distinct = common.written(spark, rows.groupBy("node", "s0", "s1").agg(F.min("doc_id").alias("first"), F.max("words").alias("words")), "wide-distinct")
    found = similar_links(spark, distinct, similarity=similarity, sets=rows.select("node", "shingles"))
    each = _named(distinct.select("node", "first"), graph.components(spark, found))
    return rows.select("doc_id", "h", "node"), common.written(spark, each, "components")


def similar_groups(spark: SparkSession, docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = WIDE_SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, component_id): groups of texts linked by a Jaccard similarity of at least ``similarity`` of their sets of word shingles.

    Defined results: a text of fewer words than ``shingle`` has the one shingle
    of all its words; null, empty and blank texts have none, and are one group;
    the rest as for ``groups``.
    """
    common.prepare(spark)
    rows, each = _similar(spark, docs, key, text, shingle, similarity)
    return rows.join(each, "node").select("doc_id", "component_id")


def keep_one(spark: SparkSession, docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS, drop_rows: int = 1_000_000) -> DataFrame:
    """The documents, one row of each group of linked fingerprints; see ``_keep_least``."""
    common.prepare(spark)
    return _keep_least(spark, docs, *_groups(spark, docs, key, text, shingle, radius), key, text, drop_rows)


def keep_dissimilar(spark: SparkSession, docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = WIDE_SHINGLE, similarity: float = SIMILARITY, drop_rows: int = 1_000_000) -> DataFrame:
    """The documents, one row of each group of similar texts; see ``_keep_least``."""
    common.prepare(spark)
    return _keep_least(spark, docs, *_similar(spark, docs, key, text, shingle, similarity), key, text, drop_rows)


def _keep_least(spark: SparkSession, docs: DataFrame, rows: DataFrame, components: DataFrame, key: str, text: str, drop_rows: int) -> DataFrame:
    """Of each component the row with the smallest key (ties: the smallest text hash), in the columns of ``docs``.

    Rows are dropped, never keys: texts of one key stay if they lie in different
    components; of exactly repeated rows one stays.  Rows with a null key all stay.
    """
    own = rows.filter("doc_id IS NOT NULL").groupBy("doc_id", "h", "node").agg(F.count("*").alias("n"))  # repeated rows are one here
    own = common.written(spark, own.join(components.select("node", "root"), "node"), "own")
    first = own.groupBy("root").agg(F.min(F.struct("doc_id", "h")).alias("f")).select("f.doc_id", "f.h")
    names = {"doc_id": F.col(key).cast("long"), "h": F.xxhash64(F.col(text).cast("string"))}
    kept = common.without_rows(docs, own.join(first, ["doc_id", "h"], "left_anti"), names, drop_rows)
    repeated = own.filter("n > 1")
    if repeated.isEmpty():
        return kept
    again = repeated.join(first, ["doc_id", "h"], "left_semi")
    once = kept.join(again.select(F.col("doc_id").alias("_out_doc_id"), F.col("h").alias("_out_h")), [names["doc_id"].eqNullSafe(F.col("_out_doc_id")), names["h"].eqNullSafe(F.col("_out_h"))], "left_semi")
    return common.without_rows(kept, again, names, drop_rows).unionByName(once.withColumns({"_out_doc_id": names["doc_id"], "_out_h": names["h"]}).dropDuplicates(["_out_doc_id", "_out_h"]).drop("_out_doc_id", "_out_h"))
