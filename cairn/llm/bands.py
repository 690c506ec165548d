"""Links between similar sketched rows that share a band, without any pair of a group being lost or a group being written out.

``nodes`` are (node, s0, s1, whole): a 128-bit sketch in two longs, and the whole
signature as an array.  A node has a key in each of its lanes (``bands``); nodes
that share one are candidates.  A ``Scheme`` says how far sketches may be apart,
whether whole signatures allow a pair, and in which lane a pair meets first;
the exact similarity of their sets has the last word on every pair.

The first round tries about a pair for each row of a band in the first lanes,
which connects most of what belongs together.  What is left open are pairs that
share a band and that no link connects; nodes with such a partner by the sketch
are dealt again with their whole signatures.  Middle rounds, each in a share of
the lanes of its own, try one pair for each of them, with its likeliest partner in
another component, as long as enough of them hold; so each place is looked at once.
The last round tries all open pairs that the whole signatures allow, each
from the first lane that it shares, so a pair that fails never stands for
another one.  Its pairs may be as many as a template's texts squared, so they
are never rows: a node has a list of its partners, and meets their sets in the
task of the cluster that these pairs connect, where they are compared exactly.
Only clusters whose sets exceed ``CLUSTER`` hashes are compared pair by pair.

Crowded bands, of more than ``bucket`` rows: in the first round they go in
blocks, each by itself.  Later their keys get longer: each row goes
to the band's parts by its ``finer`` keys, a fixed number of copies, and a part
whose rows are all connected is left out, so neither chance meetings in a band
nor groups of near copies grow with the square.  Only a part that is still
crowded and open, as a template whose texts are alike but not linked makes it,
goes in blocks: each meets every block of the rows outside the part's largest
component.  That is as large as its definition, n rows times those outside over
``bucket``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm import common, graph

BUCKET = 4096
#: Rows of a group up to which all pairs are looked at, lag by lag.
_SMALL = 48
MIDDLE_ROUNDS = 4
#: Of the pairs that a middle round tries, the share that must hold for another one to follow.
MIDDLE_YIELD = 0.05
#: Hashes (of 8 bytes) of all sets of a cluster that one task compares.
CLUSTER = 4_000_000
#: Rows of (node) or (node, root) up to which a table is broadcast.
KEYS = 500_000
PIVOTS = np.random.default_rng(20240607).integers(0, 2**64, size=16, dtype=np.uint64)


@dataclass(frozen=True)
class Scheme:
    """What pairs are candidates.

    ``bands`` and ``finer``: arrays of long keys over a node's columns; those of
    different lanes, or finer ones of different places, never agree by intent.
    """

    bands: Column
    finer: Column
    first_lanes: int
    sketch_radius: int
    plausible: Callable[[np.ndarray, np.ndarray], np.ndarray]
    likeness: Callable[[np.ndarray, np.ndarray], np.ndarray]
    first_shared: Callable[[np.ndarray, np.ndarray], np.ndarray]


def pivot_table(fps: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fps[:, None] ^ PIVOTS[None, :]).astype(np.int8)


def _spans(group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    return starts, np.diff(np.concatenate((starts, [len(group)])))


def _likely_pairs(group: np.ndarray, turn: np.ndarray, sketch: np.ndarray, radius: int, seen: set) -> list[tuple[int, int]]:
    """Some pairs of rows of one group whose sketches are within ``radius``, as many as rows at most.

    Not all of them: in small groups the forest of the closest pairs; in larger
    ones stars whose centres change with the band, so that no one centre decides
    for all bands.  ``_open_pairs`` gives all that these leave undecided.
    Pivots first: a coordinate that differs by more than the radius discards.
    """
    table = pivot_table(sketch[:, 0]) + pivot_table(sketch[:, 1])
    links: list[tuple[int, int]] = []
    close: list[tuple[int, int, int]] = []

    def near(one, rest):
        ok = np.flatnonzero(np.abs(table[rest] - table[one]).max(axis=1) <= radius)
        return ok[np.bitwise_count(sketch[rest[ok]] ^ (sketch[one[ok]] if isinstance(one, np.ndarray) else sketch[one])).sum(axis=1) <= radius]

    starts, sizes = _spans(group)
    small, last = np.repeat(sizes <= _SMALL, sizes), np.repeat(starts + sizes, sizes)
    every = np.arange(len(group))
    for lag in range(1, _SMALL):
        i = np.flatnonzero(small & (every + lag < last))
        if not len(i):
            break
        hit = near(i, i + lag)
        close += [(d, x, x + lag) for d, x in zip(np.bitwise_count(sketch[i[hit]] ^ sketch[i[hit] + lag]).sum(axis=1).tolist(), i[hit].tolist())]
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[p]
        return x

    for _, x, y in sorted(close):  # the closest pairs that connect each group: those that will most likely hold
        a, b = find(x), find(y)
        if a != b:
            parent[b] = a
            links.append((x, y))
    for s, n in zip(starts[sizes > _SMALL].tolist(), sizes[sizes > _SMALL].tolist()):
        order = s + np.argsort((sketch[s : s + n, 0] ^ turn[s]) * np.uint64(0x9E3779B97F4A7C15), kind="stable")
        while len(order) > 1:
            x, order = int(order[0]), order[1:]
            hit = near(x, order)
            links += [(x, y) for y in order[hit].tolist()]
            order = np.delete(order, hit)
    out = []
    for x, y in links:
        a, b = tuple(sketch[x].tolist()), tuple(sketch[y].tolist())
        pair = (a, b) if a < b else (b, a)
        if pair not in seen:
            seen.add(pair)
            out.append((x, y))
    return out


def _open_pairs(group: np.ndarray, side: np.ndarray, comp: np.ndarray, sketch: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows of one group with sketches within ``radius`` that no link connects yet; rows of side 0 meet those of side 1 only."""
    starts, sizes = _spans(group)
    small, last = np.repeat(sizes <= _SMALL, sizes), np.repeat(starts + sizes, sizes)
    every = np.arange(len(group))
    for lag in range(1, _SMALL):
        i = np.flatnonzero(small & (every + lag < last))
        if not len(i):
            break
        i = i[(comp[i] != comp[i + lag]) & ((side[i] == 2) | (side[i] != side[i + lag]))]
        i = i[np.bitwise_count(sketch[i] ^ sketch[i + lag]).sum(axis=1) <= radius]
        yield i, i + lag
    for s, n in zip(starts[sizes > _SMALL].tolist(), sizes[sizes > _SMALL].tolist()):
        y = np.arange(s, s + n)
        values, counts = np.unique(comp[y], return_counts=True)
        top = values[np.argmax(counts)]  # rows of the largest component needn't meet one another
        if side[s] == 2:
            rest = y[comp[y] != top]
        else:
            rest, y = y[side[y] == 1], y[side[y] == 0]
        step = max(1, (1 << 20) // n)
        for x in (rest[i : i + step, None] for i in range(0, len(rest), step)):
            near = np.bitwise_count(sketch[x, 0] ^ sketch[y, 0]) + np.bitwise_count(sketch[x, 1] ^ sketch[y, 1]) <= radius
            at, other = np.nonzero(near & (comp[x] != comp[y]) & ((side[s] < 2) | (y > x) | (comp[y] == top)))
            yield x[at, 0], y[other]


def _by_group(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The columns of batches in order of the first one, in pieces of whole groups; a list column is a matrix."""
    held: list[np.ndarray] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = [c.flatten().to_numpy().reshape(batch.num_rows, -1) if pa.types.is_list(c.type) else c.to_numpy() for c in batch.columns]
        if held is not None:
            now = [np.concatenate(pair) for pair in zip(held, now)]
        changed = np.flatnonzero(now[0] != now[0][-1])
        cut = changed[-1] + 1 if len(changed) else 0  # the last group may go on in the next batch
        if cut:
            yield [c[:cut] for c in now]
        held = [c[cut:] for c in now]
    if held is not None:
        yield held


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def links(spark: SparkSession, nodes: DataFrame, scheme: Scheme, sets: Callable[[DataFrame], DataFrame] | None, similarity: float, *, bucket: int = BUCKET, cluster: int = CLUSTER) -> DataFrame:
    """Links (a, b) of ``node`` that connect whatever shares a band, is allowed by ``scheme`` and has sets of that Jaccard similarity.

    ``sets``: from a table of nodes to (node, shingles), one row for each of them; without it ``scheme`` decides.
    """

    def verify(close: DataFrame) -> DataFrame:
        return close if sets is None else similar(spark, close, sets, similarity)

    radius, plausible, likeness, first_shared = scheme.sketch_radius, scheme.plausible, scheme.likeness, scheme.first_shared

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for band, node, lane, s0, s1 in _by_group(batches):
            found = []
            if len(band) > 1:
                group = np.concatenate(([0], np.cumsum(band[1:] != band[:-1])))
                found = _likely_pairs(group, (lane % 2).astype(np.uint64), np.stack((s0, s1), axis=1).view(np.uint64), radius, seen)
                if len(seen) > 100_000:  # a repeated candidate costs little
                    seen.clear()
            x, y = np.array([p[0] for p in found], dtype=np.int64), np.array([p[1] for p in found], dtype=np.int64)
            yield _pairs(node[x], node[y])

    def allowed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                wa, wb = (batch.column(i).flatten().to_numpy().reshape(batch.num_rows, -1) for i in (2, 3))
                yield batch.select(["a", "b"]).filter(pa.array(plausible(wa, wb)))

    def open_pairs(band, side, comp, sketch):
        if len(band) > 1:
            group = np.concatenate(([0], np.cumsum(band[1:] != band[:-1])))
            yield from _open_pairs(group, side, comp, sketch, radius)

    def active(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The places, band by band, of rows that have a partner in another component, by the sketch."""
        for band, node, s0, s1, comp, side, lane in _by_group(batches):
            hit = np.zeros(len(node), dtype=bool)
            for x, y in open_pairs(band, side, comp, np.stack((s0, s1), axis=1).view(np.uint64)):
                hit[x] = hit[y] = True
            yield pa.RecordBatch.from_arrays([pa.array(c[hit]) for c in (band, node, side, lane)], ["band", "node", "side", "lane"])

    def likeliest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each row of a piece that has one, its likeliest partner in another component."""
        for band, node, s0, s1, comp, side, lane, whole in _by_group(batches):
            most, partner = np.full(len(node), np.iinfo(np.int64).min), np.zeros(len(node), dtype=np.int64)
            for x, y in open_pairs(band, side, comp, np.stack((s0, s1), axis=1).view(np.uint64)):
                for i in range(0, len(x), 1 << 14):
                    a, b = x[i : i + (1 << 14)], y[i : i + (1 << 14)]
                    ok = plausible(whole[a], whole[b])
                    a, b = np.concatenate((a[ok], b[ok])), np.concatenate((b[ok], a[ok]))
                    like = likeness(whole[a], whole[b])
                    order = np.argsort(like, kind="stable")  # the last of a row's writes is its likeliest one
                    order = order[like[order] > most[a[order]]]
                    most[a[order]], partner[a[order]] = like[order], node[b[order]]
            found = np.flatnonzero(most > np.iinfo(np.int64).min)
            yield pa.RecordBatch.from_arrays([pa.array(c[found]) for c in (band, node, partner, most)], ["band", "a", "b", "like"])

    def partners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each row with open pairs its partners with larger places in the piece, and the least place that these pairs reach."""
        for band, node, s0, s1, comp, side, lane, whole in _by_group(batches):
            x, y = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
            for a, b in open_pairs(band, side, comp, np.stack((s0, s1), axis=1).view(np.uint64)):
                for i in range(0, len(a), 1 << 14):
                    p, q = a[i : i + (1 << 14)], b[i : i + (1 << 14)]
                    ok = plausible(whole[p], whole[q])
                    ok[ok] = first_shared(whole[p[ok]], whole[q[ok]]) == lane[p[ok]]
                    ok &= node[p] != node[q]
                    x.append(p[ok])
                    y.append(q[ok])
            x, y = np.concatenate(x), np.concatenate(y)
            source, target = np.concatenate((x, y)), np.concatenate((y, x))
            order = np.argsort(source, kind="stable")
            source, target = source[order], target[order]
            begin = np.flatnonzero(np.diff(source, prepend=-1))
            least, own = np.arange(len(node)), source[begin]
            while len(own):
                now = np.minimum(least[own], np.minimum.reduceat(least[target], begin))
                if (now == least[own]).all():
                    break
                least[own] = now
            upper = target > source
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(np.add.reduceat(upper, begin, dtype=np.int64) if len(own) else []))).astype(np.int32)), pa.array(node[target[upper]]))
            yield pa.RecordBatch.from_arrays([pa.array(node[own]), pa.array(node[least[own]]), lists], ["a", "root", "partners"])

    def every_pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for band, node, s0, s1, comp, side, lane, whole in _by_group(batches):
            for x, y in open_pairs(band, side, comp, np.stack((s0, s1), axis=1).view(np.uint64)):
                for i in range(0, len(x), 1 << 14):
                    a, b = x[i : i + (1 << 14)], y[i : i + (1 << 14)]
                    ok = plausible(whole[a], whole[b])
                    ok[ok] = first_shared(whole[a[ok]], whole[b[ok]]) == lane[a[ok]]
                    yield _pairs(node[a[ok]], node[b[ok]])

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.repartition("band").sortWithinPartitions("band")

    def blocks(n: str) -> Column:
        return F.ceil(F.col(n) / bucket)

    def alone(rows: DataFrame) -> DataFrame:
        """Blocks of a crowded band, each by itself."""
        block = F.xxhash64("band", F.pmod(F.xxhash64("node", "band"), blocks("n")))
        return rows.join(common.few(large), "band", "left").withColumn("band", F.when(F.col("n").isNull(), F.col("band")).otherwise(block)).drop("n")

    def met(source: DataFrame, names: list[str]) -> DataFrame:
        """(band, *names, side) for the later rounds: the rows of every band that may hold open pairs."""
        rows = source.select(F.posexplode(scheme.bands).alias("lane", "band"), *dict.fromkeys([*[n for n in names if n != "lane"], *(["whole"] if hot else [])]))
        both = F.lit(2).cast("long").alias("side")
        if not hot:
            return rows.select("band", *names, both)
        crowded = common.few(large.select("band"))
        longer = rows.join(crowded, "band", "left_semi").select("band", *dict.fromkeys([*names, "whole"]), F.explode(scheme.finer).alias("_finer"))
        longer = longer.select(F.xxhash64("band", "_finer").alias("band"), *names)
        sizes = longer.groupBy("band", "comp").agg(F.count("*").alias("n")).groupBy("band")
        sizes = sizes.agg(F.sum("n").alias("n"), (F.sum("n") - F.max("n")).alias("rest"), F.max_by("comp", F.struct("n", "comp")).alias("top")).filter("rest > 0")
        longer = longer.join(common.written(spark, sizes, "open"), "band")
        still = longer.filter(F.col("n") > bucket)
        meet = lambda i, j: F.xxhash64("band", i, j).alias("band")
        own, other = F.pmod(F.xxhash64("node", "band"), blocks("n")), F.pmod(F.xxhash64("band", "node"), blocks("rest"))
        upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), blocks(n) - 1)).alias("_j")
        every = still.select("band", *names, own.alias("_i"), upto("rest")).select(meet("_i", "_j"), *names, F.lit(0).cast("long").alias("side"))
        rest = still.filter("comp <> top").select("band", *names, other.alias("_i"), upto("n")).select(meet("_j", "_i"), *names, F.lit(1).cast("long").alias("side"))
        usual = rows.join(crowded, "band", "left_anti").select("band", *names, both)
        return usual.unionByName(longer.filter(F.col("n") <= bucket).select("band", *names, both)).unionByName(every).unionByName(rest)

    whole = nodes.select("node", "whole")
    lanes = F.slice(scheme.bands, 1, scheme.first_lanes)
    every = nodes.select(F.explode(scheme.bands).alias("band"))
    large = common.written(spark, every.groupBy("band").agg(F.count("*").alias("n")).filter(F.col("n") > bucket), "large")
    hot = not large.isEmpty()
    some = nodes.select(F.posexplode(lanes).alias("lane", "band"), "node", "s0", "s1").withColumn("lane", F.col("lane").cast("long"))
    tried = dealt((alone(some) if hot else some).select("band", "node", "lane", "s0", "s1")).mapInArrow(first, "a long, b long")
    tried = tried.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    both = tried.join(whole.select(F.col("node").alias("a"), F.col("whole").alias("wa")), "a").join(whole.select(F.col("node").alias("b"), F.col("whole").alias("wb")), "b")
    roots = graph.components(spark, verify(common.written(spark, both.select("a", "b", "wa", "wb").mapInArrow(allowed, "a long, b long"), "close")))
    extra: list[DataFrame] = []

    def placed(some: DataFrame) -> DataFrame:
        return common.written(spark, some.join(common.few(roots, KEYS), "node", "left").withColumn("comp", F.coalesce("root", "node")).drop("root"), "nodes")

    def one_way(pairs: DataFrame) -> DataFrame:
        return pairs.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    def left(places: DataFrame, now: DataFrame) -> DataFrame:
        """The rows of these places with what is known of their nodes now."""
        return dealt(places.join(now, "node").select("band", "node", "s0", "s1", "comp", "side", "lane", "whole"))

    def known(places: DataFrame) -> DataFrame:
        wanted = common.written(spark, places.select("node").distinct(), "known")
        return placed(nodes.join(common.few(wanted, KEYS), "node", "left_semi"))

    def as_links() -> DataFrame:
        found = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
        for more in extra:
            found = found.unionByName(more)
        return found

    now = placed(nodes)
    places = dealt(met(now, ["node", "s0", "s1", "comp", "lane"]).select("band", "node", "s0", "s1", "comp", "side", "lane")).mapInArrow(active, "band long, node long, side long, lane int")
    places = common.written(spark, places, "places")
    common.drop(now)
    for turn in range(MIDDLE_ROUNDS):
        if places.isEmpty():
            return as_links()
        own = F.pmod("lane", F.lit(MIDDLE_ROUNDS)) == turn
        now = known(places.filter(own))
        found = common.written(spark, left(places.filter(own), now).mapInArrow(likeliest, "band long, a long, b long, like long"), "likeliest")
        common.drop(now)
        # open pairs only become fewer: a place without any now has none later
        still = places.filter(own).join(found.select("band", F.col("a").alias("node")), ["band", "node"], "left_semi")
        before, places = places, common.written(spark, places.filter(~own).unionByName(still), "places")
        common.drop(before)
        close = common.written(spark, one_way(found.groupBy("a").agg(F.max_by("b", F.struct("like", "b")).alias("b"))), "close")
        tries, more = close.count(), verify(close)
        extra.append(more)
        if more.count() <= MIDDLE_YIELD * tries:  # the last round takes the rest; a few links more or less change little there
            break
        roots, extra = graph.components(spark, as_links()), []
    now = known(places)
    rest = left(places, now)
    if sets is None:
        return as_links().unionByName(common.written(spark, one_way(rest.mapInArrow(every_pair, "a long, b long")), "close"))
    lists = common.written(spark, rest.mapInArrow(partners, "a long, root long, partners array<long>"), "partners")
    common.drop(now, places)
    return as_links().unionByName(_compared(spark, lists, sets, similarity, cluster))


def _compared(spark: SparkSession, lists: DataFrame, sets: Callable[[DataFrame], DataFrame], similarity: float, cluster: int) -> DataFrame:
    """A spanning forest of the similar pairs among ``lists`` (a, root, partners); each cluster of pairs meets in one task."""
    roots = graph.components(spark, lists.select("a", F.col("root").alias("b")))
    in_cluster = lambda rows, key: rows.join(roots.withColumnRenamed("node", key), key, "left").withColumn("cluster", F.coalesce("root", key)).drop("root")
    own = common.written(spark, in_cluster(sets(lists.select(F.col("a").alias("node")).distinct()), "node"), "sets")
    large = common.written(spark, own.groupBy("cluster").agg(F.sum(F.size("shingles")).alias("n")).filter(F.col("n") > cluster).select("cluster"), "large-clusters")
    asked = in_cluster(lists.filter(F.size("partners") > 0).select("a", "partners"), "a")
    here = own.select("cluster", F.lit(0).alias("kind"), "node", F.col("shingles").alias("items")).unionByName(asked.select("cluster", F.lit(1).alias("kind"), F.col("a").alias("node"), F.col("partners").alias("items")))
    here = here.join(large, "cluster", "left_anti").repartition("cluster").sortWithinPartitions("cluster", "kind")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in chain(batches, (None,)):
            ready, held = _whole_clusters(held, batch)
            if ready is not None:
                yield _pairs(*_similar_in(ready, similarity))

    found = here.mapInArrow(compare, "a long, b long")
    if large.isEmpty():
        found = common.written(spark, found, "similar")
        common.drop(own)
        return found
    apart = asked.join(large, "cluster", "left_semi").select("a", F.explode("partners").alias("b"))
    return common.written(spark, found, "similar").unionByName(similar(spark, apart, lambda nodes: own.select("node", "shingles").join(nodes, "node", "left_semi"), similarity))


def _whole_clusters(held: list[pa.RecordBatch], batch: pa.RecordBatch | None) -> tuple[pa.Table | None, list[pa.RecordBatch]]:
    """Batches in order of their first column: the rows of whole clusters so far, and those that may go on in the next batch."""
    if batch is None:
        return (pa.Table.from_batches(held) if held else None), []
    if not batch.num_rows:
        return None, held
    key = batch.column(0).to_numpy()
    changed = np.flatnonzero(key != key[-1])
    cut = int(changed[-1]) + 1 if len(changed) else 0
    if not cut and held and held[-1].column(0)[-1].as_py() != key[0]:
        return pa.Table.from_batches(held), [batch]
    if not cut:
        return None, [*held, batch]
    return pa.Table.from_batches([*held, batch.slice(0, cut)]), [batch.slice(cut)]


def _similar_in(table: pa.Table, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the similar pairs that a piece lists: rows of kind 0 are sets, those of kind 1 lists of partners."""
    kind, node = table.column("kind").to_numpy(), table.column("node").to_numpy()
    lists = table.column("items").combine_chunks()
    ends, flat = np.cumsum(np.concatenate(([0], lists.value_lengths().to_numpy()))), lists.flatten().to_numpy()
    set_rows = np.flatnonzero(kind == 0)
    order = np.argsort(node[set_rows], kind="stable")
    names, set_rows = node[set_rows][order], set_rows[order]
    size = ends[set_rows + 1] - ends[set_rows]
    place = np.zeros(len(flat), dtype=np.int64)
    inside = np.repeat(kind == 0, np.diff(ends))
    values, place[inside] = np.unique(flat[inside], return_inverse=True)
    mark, parent, links = np.zeros(len(values), dtype=bool), list(range(len(names))), []

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for row in np.flatnonzero(kind == 1).tolist():
        a, b = int(np.searchsorted(names, node[row])), np.searchsorted(names, flat[ends[row] : ends[row + 1]])
        own = place[ends[set_rows[a]] : ends[set_rows[a] + 1]]
        mark[own] = True
        for i in range(0, len(b), 256):
            some = b[i : i + 256]
            begin = np.cumsum(np.concatenate(([0], size[some])))
            at = np.arange(begin[-1]) + np.repeat(ends[set_rows[some]] - begin[:-1], size[some])
            shared = np.add.reduceat(mark[place[at]], begin[:-1], dtype=np.int64)
            for c in some[shared / (size[a] + size[some] - shared) >= similarity].tolist():
                ra, rc = find(a), find(c)
                if ra != rc:
                    parent[rc] = ra
                    links.append((a, c))
        mark[own] = False
    pairs = np.array(links, dtype=np.int64).reshape(-1, 2)
    return names[pairs[:, 0]], names[pairs[:, 1]]


def similar(spark: SparkSession, close: DataFrame, sets: Callable[[DataFrame], DataFrame], similarity: float) -> DataFrame:
    """The pairs of ``close`` (a, b) whose sets have that Jaccard similarity at least.

    ``sets``: from a table of nodes to (node, shingles), one row for each of them.
    """
    asked = common.written(spark, close.select(F.col("a").alias("node")).unionByName(close.select(F.col("b").alias("node"))).distinct(), "asked")
    own = common.written(spark, sets(asked), "sets")
    both = close.join(own.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a").join(own.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    found = common.written(spark, both.filter(shared / (F.size("sa") + F.size("sb") - shared) >= similarity).select("a", "b"), "similar")
    common.drop(asked, own)
    return found
