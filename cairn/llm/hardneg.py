"""Hard-negative mining (operator 13): norm-bucketed inner-product search.

Components become floor(``scale`` * x); a row's score for an anchor is their
integer inner product.  An anchor's positives are its best rows of the same
label; for each positive of score p, the negatives are the best rows of other
labels with scores between ``share``/100 of p and p.

Method: rows are sorted by norm, longest first, and cut into parts and, inside a
part, into buckets.  A score is at most the product of both norms, so an anchor
goes to no part and looks at no bucket whose longest row can't reach what it
still needs: the running k-th score of its positives, or, for negatives, the
lowest open limit of its windows (a window's own lower limit until it is full,
its running k-th score from then on).  Parts are taken in rounds, the few longest
first, so that later rounds know good k-th scores.

Scale: parts hold at most ``PART_ROWS`` rows; a part is one task, which keeps its
rows and streams the anchors that need it, so a label with a third of all rows is
no hot task.  Anchors are sent to parts, rows never to anchors, and each part
returns at most k rows for an anchor and window.  The driver sees one length and
count for each part.  Scores are exact: sums of integers below 2**53 in double
precision, in 64-bit integers above.

Defined results: rows with a null label, a null vector, or a null or non-finite
component take no part; neither do vectors of another length than the most usual
one, and those so long (2**31 after scaling) that a score would not fit a long.
A null id is a candidate, after all others in ties, and never an anchor.  Rows
are rows: a repeated row competes with its copies, and each copy of an anchor
has results of its own.  A positive of negative score has an empty window.  An
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairn.llm import common

SCALE = 256
EVERY, RELABEL, LABELS = 100, 7, 10
POSITIVES, NEGATIVES, SHARE = 5, 5, 80
PART_ROWS, LEAST_PART = 65_536, 2_048
#: Rows of a bucket, the unit of pruning inside a part.
BUCKET_ROWS = 2_048
#: How many times as many parts a round has as all rounds before it.
GROWTH = 8
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def usable(vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = SCALE, relabel: int = RELABEL, labels: int = LABELS) -> DataFrame:
    """(rid, vec_id, label, q, norm): the rows that take part, a number for each, in integers."""
    v, vec_id = F.col(vector), F.col(key).cast("long")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < 2.0**31 / scale))
    changed = F.when(vec_id % relabel == 0, (F.col(label) + 1) % labels).otherwise(F.col(label)).cast("long")
    rows = vectors.filter(F.col(label).isNotNull() & v.isNotNull() & fine).select(vec_id.alias("vec_id"), changed.alias("label"), F.transform(v, lambda x: F.floor(x.cast("double") * scale)).alias("q"))
    norm = F.sqrt(F.aggregate("q", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))
    rows = rows.withColumn("norm", norm).filter(F.col("norm") < 2.0**31)
    usual = rows.groupBy(F.size("q").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("q") == (usual["n"] if usual else 0)).select(F.monotonically_increasing_id().alias("rid"), "vec_id", "label", "q", "norm")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _reach(norm, longest) -> float:
    """No inner product of integer vectors of these norms is larger, rounding included."""
    return norm * longest * (1 + 1e-9) + 1


class _Part:
    """One part's rows, longest first, in buckets."""

    def __init__(self, columns: list[list], bucket_rows: int):
        self.rid, ids, self.label, q, self.norm, missing = (np.concatenate(c) for c in columns)
        self.ids, self.missing = np.where(missing, np.iinfo(np.int64).max, ids), missing
        exact = (len(q[0]) if len(q) else 1) * float(np.abs(q).max(initial=0)) < 2.0**31
        self.q = q.astype(np.float64) if exact else q
        self.cuts = [*range(0, len(q), bucket_rows), len(q)]

    def scores(self, bucket: int, anchor: np.ndarray) -> np.ndarray:
        """Exact inner products of a bucket's rows with one anchor."""
        rows = self.q[self.cuts[bucket] : self.cuts[bucket + 1]]
        if rows.dtype == np.float64 and float(np.abs(anchor).max(initial=0)) < 2.0**21:
            return (rows @ anchor.astype(np.float64)).astype(np.int64)
        return rows.astype(np.int64) @ anchor

    def best(self, anchor: dict, windows: list[tuple[int, int, int]], same: bool, k: int) -> list[tuple[int, int, int]]:
        """(window, place, score) of the k best rows in each window (low, high, need) among rows of the anchor's label, or of other labels."""
        held = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)) for _ in windows]
        need = [max(low, known) for low, _, known in windows]
        for bucket, (a, z) in enumerate(zip(self.cuts, self.cuts[1:])):
            if a == z or _reach(anchor["norm"], self.norm[a]) < min(need):
                break  # what follows is shorter still
            score = self.scores(bucket, anchor["q"])
            fits = (self.label[a:z] == anchor["label"]) if same else (self.label[a:z] != anchor["label"])
            some = np.flatnonzero(fits & (score >= min(need)) & (score <= max(high for _, high, _ in windows)) & (self.rid[a:z] != anchor["rid"]))
            if not len(some):
                continue
            for number, (low, high, known) in enumerate(windows):
                own = some[(score[some] >= need[number]) & (score[some] <= high)]
                if not len(own):
                    continue
                places, scores = np.concatenate((held[number][0], a + own)), np.concatenate((held[number][1], score[own]))
                top = np.lexsort((self.ids[places], -scores))[:k]
                held[number] = places[top], scores[top]
                if len(top) == k:
                    need[number] = max(need[number], int(scores[top[-1]]))
        return [(number, p, s) for number, (places, scores) in enumerate(held) for p, s in zip(places.tolist(), scores.tolist())]


def parts(spark: SparkSession, rows: DataFrame, part_rows: int) -> tuple[DataFrame, list[tuple[float, int]]]:
    """The rows with a part number, the longest in part 0, written; and each part's longest norm and number of rows."""
    rows = common.written(spark, rows, "vectors")
    count = rows.count()
    n = max(1, -(-count // part_rows))
    place = rows.repartitionByRange(n, F.desc("norm"), F.xxhash64("rid")).withColumn("part", F.spark_partition_id()) if n > 1 else rows.withColumn("part", F.lit(0))
    made = common.written(spark, place, "parts")
    longest = {r["part"]: (r["longest"], r["n"]) for r in made.groupBy("part").agg(F.max("norm").alias("longest"), F.count("*").alias("n")).collect()}  # a row for each part
    return made, [longest.get(p, (0.0, 0)) for p in range(max(longest, default=-1) + 1)]


def _asked(spark: SparkSession, rows: DataFrame, anchors: DataFrame, bounds: list[tuple[float, int]], first: int, last: int, *, same: bool, k: int, bucket_rows: int) -> DataFrame:
    """(anchor, window, rid, vec_id, score) from the parts first to last - 1, for ``anchors`` (rid, label, q, norm, windows: array of (low, high, known))."""
    edges = spark.sparkContext.broadcast([b[0] for b in bounds[first:last]])
    windows = "array<struct<low:long,high:long,known:long>>"

    def to_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longest = np.array(edges.value)
        step = max(1, 16_384 // len(longest))  # anchors of a slice, so that a batch's copies for all parts are bounded
        for batch in (whole.slice(i, step) for whole in batches for i in range(0, whole.num_rows, step)):
            norm = batch.column(3).to_numpy()
            needs = [min(max(w["low"], w["known"]) for w in ws) if ws else np.inf for ws in batch.column(4).to_pylist()]
            go = _reach(norm[:, None], longest[None, :]) >= np.array(needs, dtype=np.float64).reshape(-1, 1)
            at, part = np.nonzero(go)
            taken = batch.take(pa.array(at))
            nulls = pa.nulls(len(at), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array((part + first).astype(np.int32)), pa.array(np.ones(len(at), dtype=np.int32)), taken.column(0), nulls, *taken.columns[1:]], ["part", "query", "rid", "vec_id", "label", "q", "norm", "windows"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, part = None, [[] for _ in range(6)], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, query, rid, label, norm = (batch.column(i).to_numpy() for i in (0, 1, 2, 4, 6))
            q = _matrix(batch.column(5))
            ids, missing = batch.column(3).fill_null(0).to_numpy(), batch.column(3).is_null().to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(np.diff(keys.astype(np.int64) * 2 + query)) + 1).tolist(), batch.num_rows]
            for a, z in zip(cuts, cuts[1:]):
                if keys[a] != number:
                    number, held, part = keys[a], [[] for _ in range(6)], None
                if query[a] == 0:  # the part's rows come first, the longest before all
                    for column, value in zip(held, (rid, ids, label, q, norm, missing)):
                        column.append(value[a:z])
                    continue
                if not held[0]:
                    continue
                part = part or _Part(held, bucket_rows)
                found = []
                for at, ws in zip(range(a, z), batch.column(7).slice(a, z - a).to_pylist()):
                    anchor = {"rid": rid[at], "label": label[at], "q": q[at], "norm": norm[at]}
                    found += [(rid[at], w, p, s) for w, p, s in part.best(anchor, [(w["low"], w["high"], w["known"]) for w in ws], same, k)]
                at, w, p, s = (np.array(c, dtype=np.int64) for c in zip(*found)) if found else [np.zeros(0, dtype=np.int64)] * 4
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(w), pa.array(part.rid[p]), pa.array(part.ids[p], mask=part.missing[p]), pa.array(s)], ["anchor", "window", "rid", "vec_id", "score"])

    held = rows.filter((F.col("part") >= first) & (F.col("part") < last))
    held = held.select("part", F.lit(0).alias("query"), "rid", "vec_id", "label", "q", "norm", F.expr(f"cast(null as {windows})").alias("windows"))
    sent = anchors.select("rid", "label", "q", "norm", "windows").mapInArrow(to_parts, f"part int, query int, rid long, vec_id long, label long, q array<long>, norm double, windows {windows}")
    dealt = held.unionByName(sent).withColumn("task", F.col("part") - first).repartitionById(last - first, "task").sortWithinPartitions("part", "query", F.desc("norm")).drop("task")
    return dealt.mapInArrow(scan, "anchor long, window long, rid long, vec_id long, score long")


def _rounds(parts_: int) -> list[tuple[int, int]]:
    """(first, last) of each round: one part, then ``GROWTH`` times as many as before."""
    cuts = [0]
    while cuts[-1] < parts_:
        cuts.append(min(parts_, max(1, cuts[-1] * (GROWTH + 1))))
    return list(zip(cuts, cuts[1:]))


def _ranked(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "rid")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _search(spark: SparkSession, rows: DataFrame, anchors: DataFrame, bounds: list[tuple[float, int]], *, same: bool, k: int, bucket_rows: int) -> DataFrame:
    """(anchor, window, rid, vec_id, score, rank): the k best rows in each of the anchors' windows over all parts."""
    best: DataFrame | None = None
    for first, last in _rounds(len(bounds)):
        now = anchors
        if best is not None:  # the k-th score so far is what a further row must reach
            known = best.filter(F.col("rank") == k).groupBy(F.col("anchor").alias("rid")).agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("known"))
            raised = F.expr("transform(windows, (w, i) -> named_struct('low', w.low, 'high', w.high, 'known', greatest(w.known, coalesce(try_element_at(known, cast(i as bigint)), w.known))))")
            now = anchors.join(known, "rid", "left").withColumn("windows", raised).drop("known")
        found = _asked(spark, rows, now, bounds, first, last, same=same, k=k, bucket_rows=bucket_rows)
        best = common.written(spark, _ranked(found if best is None else found.unionByName(best.drop("rank")), k), "best")
    return best


def mine(
    spark: SparkSession, vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", label: str = "label", every: int = EVERY, relabel: int = RELABEL, labels: int = LABELS,
    positives: int = POSITIVES, negatives: int = NEGATIVES, share: int = SHARE, part_rows: int | None = None, bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Each anchor's positives with their hardest negatives; anchors are the rows whose id is divisible by ``every``."""
    common.prepare(spark)
    rows = usable(vectors, key=key, vector=vector, label=label, relabel=relabel, labels=labels)
    if part_rows is None:  # so many parts that all cores have work, where the table is large enough
        part_rows = min(PART_ROWS, max(LEAST_PART, -(-vectors.count() // (2 * spark.sparkContext.defaultParallelism))))
    rows, bounds = parts(spark, rows, part_rows)
    if not bounds:
        return spark.createDataFrame([], RESULT)
    window = lambda low, high: F.struct(low.cast("long").alias("low"), high.cast("long").alias("high"), F.lit(-(2**62)).cast("long").alias("known"))
    anchors = rows.filter(F.col("vec_id") % every == 0).select("rid", "vec_id", "label", "q", "norm")
    all_scores = F.array(window(F.lit(-(2**62)), F.lit(2**62)))
    near = _search(spark, rows, anchors.withColumn("windows", all_scores), bounds, same=True, k=positives, bucket_rows=bucket_rows)
    near = near.filter("score >= 0").select("anchor", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    limits = near.groupBy(F.col("anchor").alias("rid")).agg(F.sort_array(F.collect_set("positive_score")).alias("limits"))
    windows = F.transform("limits", lambda p: window(F.floor((p.cast("decimal(30,0)") * share + 99) / 100), p))
    limits = limits.withColumn("windows", windows)
    far = _search(spark, rows, anchors.join(limits.select("rid", "windows"), "rid"), bounds, same=False, k=negatives, bucket_rows=bucket_rows)
    named = limits.select("rid", F.posexplode("limits").alias("window", "positive_score"))
    both = far.select(F.col("anchor").alias("rid"), "window", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"), "rank")
    both = both.join(named, ["rid", "window"]).join(near.withColumnRenamed("anchor", "rid"), ["rid", "positive_score"]).join(anchors.select("rid", F.col("vec_id").alias("anchor_id")), "rid")
    return both.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def oracle() -> str:
    """The same result as DuckDB SQL over the view ``embeddings``: all anchors against all rows."""
    return f"""WITH e AS (SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % {RELABEL} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
        list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS q FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
      s AS (SELECT a.rid AS ar, a.vec_id AS anchor_id, a.label AS al, b.rid, b.vec_id, b.label, CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
        FROM e a JOIN e b ON a.rid <> b.rid WHERE a.vec_id % {EVERY} = 0),
      p AS (SELECT ar, anchor_id, rid AS pr, vec_id AS positive_id, score AS positive_score FROM s WHERE label = al QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id) <= {POSITIVES}),
      n AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY p.ar, p.pr ORDER BY s.score DESC, s.vec_id) AS rank
        FROM p JOIN s USING (ar) WHERE s.label <> s.al AND {SHARE} * positive_score <= 100 * s.score AND s.score <= positive_score)
      SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= {NEGATIVES}"""
