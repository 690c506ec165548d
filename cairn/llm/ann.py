"""Approximate nearest neighbours by additive quantisation (operator 3).

A vector is approximated by the sum of one full-dimensional codeword from each
of ``BOOKS`` codebooks; the codebooks are fitted to the residuals the ones
before leave.  Encoding is a beam search over the codebooks, so a codeword that
is second best alone can win with those that follow.  The index keeps a
vector's codes and its norm; a query's score of a code is the sum of entries of
its lookup tables (inner products with all codewords), scaled by the stored
norm.  The best ``rerank`` are scored again on the original vectors in double
precision, and so is every row that its code doesn't rule out: the angle between
a row and its approximation is known, so the query's angle to the approximation
bounds its score, and rows below the k-th best found are dropped.

Coarse lists stand before the codes: vectors are dealt by direction to the
nearest of about the square root of their number of centres.  A query's k-th
best score in the sample is a lower limit of its k-th best score; it looks at
every list whose widest angle and longest row may reach that.  Both bounds lose
no neighbour, whatever the rows are like: of other kind than the queries, in
tight groups, of many dimensions, or with few long ones among them.  What varies
is the work: clustered data need few lists and rows, data without any structure
nearly all of them.

Scale: codebooks are fitted on at most ``FIT_ROWS`` vectors, those with the
smallest hashes, and centres on ``LIST_ROWS`` for each list if that is more,
32,768 at most (a bounded, documented sample); every vector is indexed.  Lists are dealt to parts of about ``PART_ROWS`` rows, a larger list to
several, so a third of all rows in one list is no hot task.  Queries never pass
the driver: each is sent to the parts of its lists, and meets their rows there;
k rows for each query and part are shuffled, and ranked with a group limit.

Defined results: null or zero vectors, those with null or non-finite components
or another length than the most usual one, and rows without an id, take no part;
equal scores go to the smaller id, and scores that over- and underflow at once
(not a number) come last; repeated rows compete as rows, and each row whose
id makes it a query is one of its own (a repeated id has its k rows as often as
it is there, each copy being the other's neighbour); extra columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairn.llm import common

BOOKS, WORDS, BEAM = 16, 256, 4
FIT_ROWS = 8_000
#: What rounding may change in a cosine: of doubles, and of lookup tables of floats.
ROUNDING, TABLE_ROUNDING = 1e-9, 1e-5
#: Lists grow with the square root of the rows up to this; the sample has at least ``LIST_ROWS`` rows for each.
MOST_LISTS, LIST_ROWS = 4_096, 8
PART_ROWS = 8_192
#: Rows of a query that are scored exactly before bounds are: so many, or that share of the rows in its lists if it is more.
RERANK, RERANK_SHARE = 1_000, 0.02


def centres_of(x: np.ndarray, n: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    """k-means centres; an empty one takes a random row."""
    centres = x[rng.choice(len(x), n, replace=False)].copy()
    for _ in range(rounds):
        near = nearest_centre(x, centres)
        order = np.argsort(near, kind="stable")
        begin = np.flatnonzero(np.diff(near[order], prepend=-1))
        count = np.diff(np.append(begin, len(order)))
        found = near[order[begin]]
        centres[found] = np.add.reduceat(x[order], begin, axis=0) / count[:, None]
        empty = np.setdiff1d(np.arange(n), found)
        centres[empty] = x[rng.choice(len(x), len(empty))]
    return centres


def nearest_centre(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmax(x @ centres.T - 0.5 * (centres**2).sum(axis=1), axis=1)


class Quantiser:
    """Additive codebooks of shape (books, words, dim)."""

    def __init__(self, codebooks: np.ndarray):
        self.codebooks = codebooks.astype(np.float32)
        self.squares = np.einsum("bwd,bwd->bw", self.codebooks, self.codebooks).astype(np.float32)

    @classmethod
    def fit(cls, x: np.ndarray, books: int = BOOKS, words: int = WORDS, rounds: int = 6, seed: int = 7) -> "Quantiser":
        rng = np.random.default_rng(seed)
        left, found = x.astype(np.float32), []
        for _ in range(books):
            w = min(words, len(left))
            centres = centres_of(left, w, rounds, rng)
            left = left - centres[nearest_centre(left, centres)]
            found.append(np.concatenate((centres, np.repeat(centres[:1], words - w, axis=0))))
        return cls(np.stack(found))

    def encode(self, x: np.ndarray, beam: int = BEAM) -> np.ndarray:
        """Codes (n, books) by beam search: the ``beam`` best partial sums go on, each with what it leaves of the vector."""
        n, (books, words, dim) = len(x), self.codebooks.shape
        left = x.astype(np.float32)[:, None, :]
        codes = np.zeros((n, 1, 0), dtype=np.int64)
        errors = np.zeros((n, 1), dtype=np.float32)
        for b in range(books):
            gain = self.squares[b] - 2 * (left.reshape(-1, dim) @ self.codebooks[b].T).reshape(n, -1, words)
            flat = (gain + errors[:, :, None]).reshape(n, -1)
            k = min(beam, flat.shape[1])
            best = np.argpartition(flat, k - 1, axis=1)[:, :k]
            errors = np.take_along_axis(flat, best, axis=1)
            before = (best // words)[:, :, None]
            codes = np.concatenate((np.take_along_axis(codes, before, axis=1), (best % words)[:, :, None]), axis=2)
            left = np.take_along_axis(left, before, axis=1) - self.codebooks[b][best % words]
        return np.take_along_axis(codes, errors.argmin(axis=1)[:, None, None], axis=1)[:, 0].astype(np.uint8 if words <= 256 else np.uint16)

    def decode(self, codes: np.ndarray) -> np.ndarray:
        return sum(self.codebooks[b][codes[:, b]] for b in range(self.codebooks.shape[0]))


@dataclass
class Index:
    """``rows``: (rid, vec_id, v, list, codes, norm), a number for each row; what tasks need to search it.

    Of each list its centre's direction, rows, least cosine to the centre, and least and largest norm.
    """

    rows: DataFrame
    quantiser: Quantiser
    centres: np.ndarray
    sample: np.ndarray
    sizes: np.ndarray
    cosines: np.ndarray
    norms: np.ndarray


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, v): the rows that take part; vectors keep their type."""
    v = F.col(vector)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), v.alias("v")).filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & fine)
    usual = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("v") == (usual["n"] if usual else 0))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _unit(x: np.ndarray) -> np.ndarray:
    """Directions; the largest component goes first, so that no square under- or overflows."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _norms(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    largest = np.abs(x).max(axis=1)
    with np.errstate(over="ignore"):
        return largest * np.linalg.norm(x / largest[:, None], axis=1)


def most_cosine(to: np.ndarray, around: np.ndarray, rounding: float) -> np.ndarray:
    """The largest cosine to rows of directions with a cosine of ``around`` or more to one that the query has the cosine ``to`` with."""
    to, around = np.minimum(to + rounding, 1.0), np.maximum(around - rounding, -1.0)
    away = np.sqrt(1 - np.clip(np.abs(to) - 2 * rounding, 0, 1) ** 2) * np.sqrt(1 - np.clip(np.abs(around) - rounding, 0, 1) ** 2)
    return np.where(to >= around, 1.0, np.minimum(1.0, to * around + away)) + rounding


def below(bound: np.ndarray, least: float) -> np.ndarray:
    """Which bounds rule out a score of ``least``: never one that is not a number, nor by less than the smallest doubles."""
    return bound < least - 1e-300


def kth_at_least(sample: np.ndarray, norms: np.ndarray, queries: np.ndarray, k: int) -> np.ndarray:
    """For each query a lower limit of its k-th best score: the (k + 1)-th in the sample, which may hold the query's own row."""
    if len(sample) <= k:
        return np.full(len(queries), -np.inf)
    out = np.empty(len(queries))
    with np.errstate(over="ignore", invalid="ignore"):
        for i in range(0, len(queries), 256):
            q = queries[i : i + 256].astype(np.float64)
            scores = q @ sample.T - ROUNDING * np.outer(_norms(q), norms)
            scores[np.isnan(scores)] = -np.inf
            out[i : i + 256] = np.partition(scores, len(sample) - k - 1, axis=1)[:, len(sample) - k - 1]
    return out


def index(spark: SparkSession, vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", fit_rows: int = FIT_ROWS) -> Index | None:
    """Every usable vector with its list, codes and norm, written once; None if there is none."""
    common.prepare(spark)
    rows = usable(vectors, key, vector)
    wanted = int(min(MOST_LISTS, rows.count() ** 0.5))
    sample = rows.orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(max(fit_rows, LIST_ROWS * wanted)).select("v").toArrow().column("v").combine_chunks()
    if not len(sample):
        return None
    drawn = sample.flatten().to_numpy().reshape(len(sample), -1)
    x = _unit(drawn)
    quantiser = Quantiser.fit(x[:fit_rows])
    n_lists = max(1, min(wanted, len(x) // LIST_ROWS))
    centres = centres_of(x.astype(np.float32), n_lists, 8, np.random.default_rng(5))
    directions = centres / np.maximum(np.linalg.norm(centres.astype(np.float64), axis=1, keepdims=True), 1e-30)
    shared, dim = spark.sparkContext.broadcast((quantiser, centres, directions)), x.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quant, means, ways = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                v = _matrix(part.column(2), dim)
                u = _unit(v)
                codes = pa.array([c.tobytes() for c in quant.encode(u)], pa.binary())
                lists = nearest_centre(u.astype(np.float32), means).astype(np.int32)
                cosine = np.einsum("nd,nd->n", u, ways[lists])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(lists), codes, pa.array(_norms(v)), pa.array(cosine)], ["rid", "vec_id", "v", "list", "codes", "norm", "cosine"])

    kind = rows.schema["v"].dataType.simpleString()
    made = rows.select(F.monotonically_increasing_id().alias("rid"), "vec_id", "v").mapInArrow(run, f"rid long, vec_id long, v {kind}, list int, codes binary, norm double, cosine double")
    made = common.written(spark, made, "index")
    sizes, cosines, norms = np.zeros(n_lists, dtype=np.int64), np.ones(n_lists), np.zeros((2, n_lists))
    for r in made.groupBy("list").agg(F.count("*").alias("n"), F.min("cosine").alias("cosine"), F.min("norm").alias("least"), F.max("norm").alias("most")).collect():  # a row for each list
        sizes[r["list"]], cosines[r["list"]], norms[:, r["list"]] = r["n"], r["cosine"], (r["least"], r["most"])
    return Index(made.drop("cosine"), quantiser, directions, drawn[:fit_rows], sizes, cosines, norms)


def deal(sizes: np.ndarray, part_rows: int) -> tuple[np.ndarray, np.ndarray, int]:
    """For each list its first part and how many it has to itself, and the number of parts: small lists share, large ones are split."""
    first, own, part, filled = np.zeros(len(sizes), dtype=np.int64), np.ones(len(sizes), dtype=np.int64), 0, 0
    for number, size in enumerate(sizes.tolist()):
        if filled and filled + size > part_rows:
            part, filled = part + 1, 0
        first[number] = part
        if size > part_rows:
            own[number] = -(-size // part_rows)
            part, filled = part + int(own[number]), 0
        else:
            filled += size
    return first, own, part + 1


class _Part:
    """The index rows of one part, ready for queries."""

    def __init__(self, quantiser: Quantiser, columns: list[list]):
        rid, vec_id, lists, codes, norms, vectors = (np.concatenate(c) for c in columns)
        order = np.argsort(vec_id, kind="stable")  # equal scores: smaller ids first
        self.rid, self.vec_id, self.lists, self.codes, self.vectors = rid[order], vec_id[order], lists[order], codes[order], vectors[order]
        near = quantiser.decode(self.codes).astype(np.float64)
        length = np.linalg.norm(near, axis=1)
        self.norms, self.length = norms[order], np.maximum(length, 1e-12)
        self.factor = self.norms / self.length  # the stored norm over the approximation's
        self.cosine = np.where(length < 1e-3, -1.0, np.einsum("nd,nd->n", _unit(self.vectors), near) / self.length)  # an approximation of no direction rules out nothing
        self.exact = self.vectors.astype(np.float64)
        self.quantiser = quantiser

    def scores(self, some: np.ndarray, query: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore", invalid="ignore"):
            if 2 * len(some) > len(self.exact):
                return np.einsum("nd,d->n", self.exact, query)[some]
            return np.einsum("nd,d->n", self.exact[some], query)

    def search(self, rid: int, query: np.ndarray, probed: np.ndarray, k: int, rerank: float, least: float = -np.inf) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact scores of the best k in the probed lists, or of those of them that reach ``least``.

        Scored exactly are the best by their codes, the share ``rerank`` of the
        rows, 2 k at least, and then all that may be among the best k by them.
        """
        books = len(self.quantiser.codebooks)
        tables = self.quantiser.codebooks @ _unit(query[None, :])[0].astype(np.float32)  # the query's length changes no order
        some = np.flatnonzero(probed[self.lists] & (self.rid != rid))
        take = max(2 * k, int(rerank * len(some)))
        codes = self.codes[some]
        cosine = tables[0][codes[:, 0]]
        for b in range(1, books):
            cosine += tables[b][codes[:, b]]
        first, exact = some, None
        if take < len(some):
            with np.errstate(over="ignore", invalid="ignore"):
                guess = cosine * self.factor[some]
                most = most_cosine(cosine / self.length[some], self.cosine[some], TABLE_ROUNDING) * self.norms[some] * _norms(query[None, :])[0]
            guess[~np.isfinite(guess)] = np.inf  # beyond doubles: scored exactly
            edge = np.partition(guess, len(guess) - take)[len(guess) - take]
            taken = guess > edge
            taken[np.flatnonzero(guess == edge)[: take - np.count_nonzero(taken)]] = True  # ties at the edge: smaller ids
            first = some[taken]
            exact = self.scores(first, query)
            known = np.where(np.isnan(exact), -np.inf, exact)
            least = max(least, np.partition(known, take - k)[take - k])
            rest = some[~taken & ~below(most, least)]
            first, exact = np.concatenate((first, rest)), np.concatenate((exact, self.scores(rest, query)))
        else:
            exact = self.scores(first, query)
        best = np.lexsort((self.vec_id[first], -exact))[:k]
        return self.vec_id[first[best]], exact[best]


def search(spark: SparkSession, found: Index | None, queries: DataFrame, *, k: int = 20, rerank: int = RERANK, part_rows: int = PART_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest by inner product.

    ``queries``: (rid, vec_id, v), a number of its own for each; the index row of the same number is left out.
    """
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    common.prepare(spark)
    first, own, parts = deal(found.sizes, part_rows)
    books, words, dim = found.quantiser.codebooks.shape
    shared = spark.sparkContext.broadcast((found.quantiser, found.sample, found.centres, found.sizes, found.cosines, found.norms, first, own))
    n_lists = len(found.sizes)

    def to_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, sample, centres, sizes, cosines, norms, first, own = shared.value
        sample = sample.astype(np.float64)
        sample_norms = _norms(sample)
        for batch in batches:
            if not batch.num_rows:
                continue
            v = _matrix(batch.column(2), dim)
            least = kth_at_least(sample, sample_norms, v, k)
            rows, part, lists, reach, limit = [], [], [], [], []
            for at, (to, norm) in enumerate(zip(_unit(v) @ centres.T, _norms(v))):
                cosine = most_cosine(to, cosines, ROUNDING)
                with np.errstate(over="ignore", invalid="ignore"):
                    near = (sizes > 0) & ~below(np.where(cosine > 0, norms[1], norms[0]) * cosine * norm, least[at])
                touched = np.unique(np.concatenate([np.arange(first[c], first[c] + own[c]) for c in np.flatnonzero(near)]))
                rows += [at] * len(touched)
                part += touched.tolist()
                lists += [np.packbits(near).tobytes()] * len(touched)
                reach += [int(sizes[near].sum())] * len(touched)
                limit += [least[at]] * len(touched)
            taken = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array([1] * len(rows), pa.int32()), *taken.columns, pa.array(reach, pa.int64()), pa.array(lists, pa.binary()), pa.array(limit, pa.float64())], ["part", "query", "rid", "vec_id", "v", "list", "codes", "norm"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quant = shared.value[0]
        number, held, part = None, [[] for _ in range(6)], None
        for batch in batches:
            cells = [batch.column(i).to_numpy() for i in (0, 1, 2, 3, 5, 7)]
            vectors = _matrix(batch.column(4), dim) if batch.num_rows else None
            cuts = [0, *(np.flatnonzero(np.diff(cells[0] * 2 + cells[1])) + 1).tolist(), batch.num_rows]
            for a, z in zip(cuts, cuts[1:]):
                if a == z:
                    continue
                if cells[0][a] != number:
                    number, held, part = cells[0][a], [[] for _ in range(6)], None
                if cells[1][a] == 0:  # rows of the index come first
                    codes = np.frombuffer(b"".join(batch.column(6).slice(a, z - a).to_pylist()), dtype=np.uint8 if words <= 256 else np.uint16).reshape(-1, books)
                    for column, value in zip(held, (cells[2][a:z], cells[3][a:z], cells[4][a:z], codes, cells[5][a:z], vectors[a:z])):
                        column.append(value)
                    continue
                if not held[0]:
                    continue
                part = part or _Part(quant, held)
                out: list[list] = [[], [], [], []]
                for at in range(a, z):
                    probed = np.unpackbits(np.frombuffer(batch.column(6)[at].as_py(), dtype=np.uint8))[:n_lists].astype(bool)
                    reach = max(1, cells[4][at])
                    # the query's rows to score exactly are dealt to its parts in proportion, and a quarter more
                    ids, scores = part.search(cells[2][at], vectors[at].astype(np.float64), probed, k, 1.25 * max(rerank / reach, RERANK_SHARE), cells[5][at])
                    for column, value in zip(out, (np.full(len(ids), cells[2][at]), np.full(len(ids), cells[3][at]), ids, scores)):
                        column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["rid", "query_id", "vec_id", "score"])

    kind = found.rows.schema["v"].dataType.simpleString()
    firsts, owns = (F.split(F.lit(",".join(map(str, column.tolist()))), ",").cast("array<int>") for column in (first, own))  # folded to constants
    part = F.get(firsts, F.col("list")) + F.pmod(F.xxhash64("rid"), F.get(owns, F.col("list"))).cast("int")
    rows = found.rows.select(part.alias("part"), F.lit(0).alias("query"), "rid", "vec_id", "v", F.col("list").cast("long").alias("list"), "codes", "norm")
    asked = queries.select("rid", "vec_id", F.col("v").cast(kind).alias("v")).mapInArrow(to_parts, f"part int, query int, rid long, vec_id long, v {kind}, list long, codes binary, norm double")
    dealt = rows.unionByName(asked).repartitionById(parts, "part").sortWithinPartitions("part", "query")  # no two parts share a task by chance
    best = dealt.mapInArrow(scan, "rid long, query_id long, vec_id long, score double")
    w = Window.partitionBy("rid").orderBy(F.when(~F.isnan("score"), F.col("score")).desc_nulls_last(), "vec_id")
    return best.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(spark: SparkSession, vectors: DataFrame, *, every: int = 20, k: int = 20, key: str = "vec_id", vector: str = "embedding", rerank: int = RERANK, part_rows: int = PART_ROWS) -> DataFrame:
    """Index all vectors; the queries are the rows whose id is divisible by ``every``."""
    found = index(spark, vectors, key=key, vector=vector)
    queries = found.rows.filter(F.col("vec_id") % every == 0).select("rid", "vec_id", "v") if found else None
    return search(spark, found, queries, k=k, rerank=rerank, part_rows=part_rows)
