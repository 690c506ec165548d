"""Benchmark decontamination (operator 2).

Method: greedy string tiling.  A document and a benchmark item that share a
seed (``min_match`` running words) are tiled: the longest match of words not
yet marked, in either text, is marked, and again, until none of at least
``min_match`` words is left.  Seeds and their extension come from running
Karp-Rabin hashes, checked word by word.  The marked share of the item's words
is its coverage; tiles may lie in any order, so reordered passages count.  The
pairs of equal places are counted before they are listed; where texts are so
repetitive that they would not fit, the same tiles are found length by length.

Words are lower-cased letter-and-digit runs, and single characters of scripts
written without spaces; punctuation and layout don't matter.  An item of fewer
than ``min_match`` words is matched by all its words.

Scale: documents are read once for each block of items, and nothing about them
is shuffled.  Equal items are one text.  The texts go to the tasks in blocks of
at most ``BLOCK_BYTES`` (measured first; a longer text is a block by itself),
one block at a time: its result is written before the next one is built, so
neither the driver nor a task holds more than one, and every item meets every
document.

Defined results: null and empty texts and items match nothing; repeated items
and documents give repeated rows; null keys are carried; an empty table on
either side gives an empty result; extra columns are ignored.  ``clean`` drops
rows by their text, whatever their key.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm import common

MIN_MATCH = 5
COVERAGE = 0.6
BLOCK_BYTES = 16 << 20
#: Pairs of equal places that are listed for a document and an item; with more, tiles are found length by length.
MOST_PAIRS = 200_000
# Blocks of scripts written without spaces: Thai to Myanmar, Khmer, kana, ideographs.
_DENSE = r"\u0e00-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff"
_WORD = re.compile(rf"[^\W_{_DENSE}]+|[{_DENSE}]")
_MULT = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def running_hashes(ids: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin values (mod 2**64) of every run of ``length`` ids."""
    n = len(ids) - length + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    out = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(length):
            out = out * _MULT + mixed[i : i + n]
    return out


def _places(doc_hash: np.ndarray, item_hash: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The item's places in order of their hashes, and for each doc hash where its equal ones begin and how many there are."""
    order = np.argsort(item_hash, kind="stable")
    low = np.searchsorted(item_hash[order], doc_hash, "left")
    return order, low, np.searchsorted(item_hash[order], doc_hash, "right") - low


def matches(doc: np.ndarray, item: np.ndarray, length: int, places: tuple[np.ndarray, np.ndarray, np.ndarray]) -> list[tuple[int, int, int]]:
    """Maximal common runs (length, doc place, item place) of at least ``length`` words, from the pairs of equal ``_places``."""
    order, low, count = places
    at = np.repeat(np.arange(len(low)), count)
    if not len(at):
        return []
    ends = np.cumsum(count)
    other = order[np.arange(len(at)) - np.repeat(ends - count, count) + np.repeat(low, count)]
    same = np.ones(len(at), dtype=bool)
    for i in range(length):  # hashes may collide; the words decide
        same &= doc[at + i] == item[other + i]
    at, other = at[same], other[same]
    if not len(at):
        return []
    order = np.lexsort((at, at - other))
    at, other = at[order], other[order]
    new = np.concatenate(([True], (np.diff(at - other) != 0) | (np.diff(at) != 1)))
    begin = np.flatnonzero(new)
    runs = np.diff(np.concatenate((begin, [len(at)]))) + length - 1
    return list(zip(runs.tolist(), at[begin].tolist(), other[begin].tolist()))


def tile(doc_words: np.ndarray, item_words: np.ndarray, length: int, doc_hash: np.ndarray | None = None, item_hash: np.ndarray | None = None) -> list[tuple[int, int, int]]:
    """Greedy string tiling: tiles (doc place, item place, length); the longest first, ties to the earlier places."""
    if doc_hash is None:
        doc_hash = running_hashes(doc_words, length)
    if item_hash is None:
        item_hash = running_hashes(item_words, length)
    places = _places(doc_hash, item_hash)
    if places[2].sum() > MOST_PAIRS:
        return _tile_by_length(doc_words, item_words, length, np.flatnonzero(places[2]))
    heap = [(-n, d, i) for n, d, i in matches(doc_words, item_words, length, places)]
    heapq.heapify(heap)
    doc_marked, item_marked = np.zeros(len(doc_words), dtype=bool), np.zeros(len(item_words), dtype=bool)
    tiles = []
    while heap:
        n, d, i = heapq.heappop(heap)
        n = -n
        taken = doc_marked[d : d + n] | item_marked[i : i + n]
        if not taken.any():
            doc_marked[d : d + n] = item_marked[i : i + n] = True
            tiles.append((d, i, n))
            if item_marked.all():
                break
            continue
        edges = np.flatnonzero(np.diff(np.concatenate(([True], taken, [True])).astype(np.int8)))
        for a, z in zip(edges[::2].tolist(), edges[1::2].tolist()):  # the unmarked runs that are left
            if z - a >= length:
                heapq.heappush(heap, (a - z, d + a, i + a))
    return tiles


class _Runs:
    """Hashes of a text's runs of any length: sums of places' powers, shifted to the run's beginning (mod 2**64)."""

    def __init__(self, ids: np.ndarray):
        mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(32)
        inverse = np.uint64(pow(int(_MULT), -1, 2**64))
        with np.errstate(over="ignore"):
            power = np.concatenate(([np.uint64(1)], np.cumprod(np.full(len(ids), _MULT))))
            self.sums = np.concatenate(([np.uint64(0)], np.cumsum(mixed * power[:-1], dtype=np.uint64)))
            self.shift = np.concatenate(([np.uint64(1)], np.cumprod(np.full(len(ids), inverse))))
        self.marked = np.zeros(len(ids), dtype=bool)

    def free(self, places: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Those places where an unmarked run of that length begins, and the runs' hashes."""
        places = places[places + length < len(self.sums)]
        taken = np.concatenate(([0], np.cumsum(self.marked)))
        places = places[taken[places + length] == taken[places]]
        with np.errstate(over="ignore"):
            return places, (self.sums[places + length] - self.sums[places]) * self.shift[places]


def _tile_by_length(doc_words: np.ndarray, item_words: np.ndarray, length: int, spots: np.ndarray) -> list[tuple[int, int, int]]:
    """The tiles of ``tile`` for repetitive texts, in memory proportional to the texts: no pairs of places are listed.

    The length of the longest unmarked match is found by bisection, all tiles
    of just that length are marked from left to right, and again with what is
    left.  Lengths of tiles differ and sum to the item's at most, so rounds are few.
    """
    doc, item, tiles = _Runs(doc_words), _Runs(item_words), []
    every, most = np.arange(len(item_words)), len(item_words)

    def shared(n: int):
        d, dh = doc.free(spots, n)
        i, ih = item.free(every, n)
        order, low, count = _places(dh, ih)
        return d[count > 0], low[count > 0], i[order], ih[order]

    while most >= length:
        least, above = length - 1, most + 1  # a match of ``least`` words exists (or none is wanted), one of ``above`` doesn't
        while above - least > 1:
            middle = (least + above) // 2
            least, above = (middle, above) if len(shared(middle)[0]) else (least, middle)
        if least < length:
            break
        d, low, i, ih = shared(least)
        begin = np.flatnonzero(np.concatenate(([True], ih[1:] != ih[:-1])))
        left = {b: places.tolist()[::-1] for b, places in zip(begin.tolist(), np.split(i, begin[1:]))}  # the first place is the last of its list
        free_from = 0
        for at, group in zip(d.tolist(), low.tolist()):
            if at < free_from:
                continue
            places, skipped = left[group], []
            while places:
                to = places.pop()
                if item.marked[to : to + least].any():
                    continue
                if np.array_equal(doc_words[at : at + least], item_words[to : to + least]):
                    doc.marked[at : at + least] = item.marked[to : to + least] = True
                    tiles.append((at, to, least))
                    free_from = at + least
                    break
                skipped.append(to)  # equal hashes of different words
            places += skipped[::-1]
            if item.marked.all():
                return tiles
        most = least - 1
    return tiles


class _Block:
    """Some benchmark items, ready to be met by documents."""

    def __init__(self, items: list[tuple[int, str]], min_match: int):
        self.vocab: dict[str, int] = {}
        self.items = []
        seeds: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for item_id, text in items:
            words = words_of(text)
            if not words:
                continue
            ids = np.array([self.vocab.setdefault(w, len(self.vocab)) for w in words], dtype=np.int64)
            length = min(min_match, len(ids))
            hashes = running_hashes(ids, length)
            seeds.setdefault(length, []).append((hashes, np.full(len(hashes), len(self.items))))
            self.items.append((item_id, ids, length, hashes))
        self.seeds = {}
        for length, found in seeds.items():
            h, owner = np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])
            order = np.argsort(h, kind="stable")
            self.seeds[length] = (h[order], owner[order])

    def meet(self, text: str | None) -> Iterator[tuple[int, int, int, int]]:
        """(number of the item, words of the item, words covered, tiles) for every item with a shared seed."""
        get = self.vocab.get
        words = words_of(text)
        ids = np.fromiter((get(w, -1) for w in words), dtype=np.int64, count=len(words))
        if not (ids >= 0).any():
            return
        for length, (seeds, owners) in self.seeds.items():
            known = ids >= 0
            if length > 1 and len(ids) >= length:
                inside = np.lib.stride_tricks.sliding_window_view(known, length).all(axis=1)
            else:
                inside = known
            if not inside.any():
                continue
            hashes = running_hashes(ids, length)
            low, high = np.searchsorted(seeds, hashes, "left"), np.searchsorted(seeds, hashes, "right")
            spots = np.flatnonzero((high > low) & inside[: len(hashes)])
            if not len(spots):
                continue
            spans = np.unique(np.stack((low[spots], high[spots]), axis=1), axis=0)
            for owner in np.unique(np.concatenate([owners[a:z] for a, z in spans.tolist()])).tolist():
                item_id, item_ids, _, item_hash = self.items[owner]
                tiles = tile(ids, item_ids, length, hashes, item_hash)
                if tiles:
                    yield item_id, len(item_ids), sum(n for *_, n in tiles), len(tiles)


SCHEMA = "doc_id long, item_id long, item_words long, covered_words long, tiles long, coverage double"


def _items(spark: SparkSession, benchmark: DataFrame, item_text: str, block_bytes: int) -> tuple[DataFrame, list[int]]:
    """Distinct item texts (hash, text, bytes) dealt to blocks of about ``block_bytes`` at most, and the blocks' numbers."""
    body = F.col(item_text).cast("string")
    texts = benchmark.filter(body.isNotNull()).select(body.alias("text")).distinct()
    texts = common.written(spark, texts.select(F.xxhash64("text").alias("hash"), "text", F.octet_length("text").cast("long").alias("bytes")), "items")
    blocks = -(-(texts.agg(F.sum("bytes")).first()[0] or 0) // block_bytes) or 1
    while True:  # as many as it takes until no block of several texts is too large
        dealt = texts.withColumn("block", F.pmod("hash", F.lit(blocks)))
        sizes = dealt.groupBy("block").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")).collect()  # a row for each block
        if blocks == 1 or all(r["n"] < 2 or r["bytes"] <= block_bytes for r in sizes):
            return dealt, sorted(r["block"] for r in sizes)
        blocks *= 2


def _passes(spark: SparkSession, dealt: DataFrame, blocks: list[int], min_match: int, one_pass) -> list[DataFrame]:
    """``one_pass(block)`` for each block of items; with several, each result is written before the next block is made."""
    found = []
    for number in blocks:
        block = spark.sparkContext.broadcast(_Block([(r["hash"], r["text"]) for r in dealt.filter(F.col("block") == number).orderBy("hash").collect()], min_match))
        part = one_pass(block)
        if len(blocks) > 1:
            part = common.written(spark, part, "met")
            block.unpersist()
        found.append(part)
    return found


def overlaps(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, *, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", min_match: int = MIN_MATCH, coverage: float = COVERAGE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(document, item) pairs whose tiles cover at least ``coverage`` of the item's words."""
    common.prepare(spark)
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    met = SCHEMA.replace("item_id", "hash")
    names = [x.split()[0] for x in met.split(", ")]

    def one_pass(shared) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in common.sliced(batches, 1):
                rows = []
                for doc, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    for item, n, covered, tiles in shared.value.meet(body):
                        if covered >= coverage * n:
                            rows.append((doc, item, n, covered, tiles, covered / n))
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows) if rows else [()] * 6, [pa.int64()] * 5 + [pa.float64()])], names)

        return texts.mapInArrow(run, met)

    parts = _passes(spark, *_items(spark, benchmark, item_text, block_bytes), min_match, one_pass)
    if not parts:
        return spark.createDataFrame([], SCHEMA)
    owners = benchmark.filter(F.col(item_text).isNotNull()).select(F.col(item_key).cast("long").alias("item_id"), F.xxhash64(F.col(item_text).cast("string")).alias("hash"))
    return reduce(DataFrame.unionByName, parts).join(owners, "hash").select(*[x.split()[0] for x in SCHEMA.split(", ")])


def clean(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item_text: str = "text", min_match: int = MIN_MATCH, coverage: float = COVERAGE, block_bytes: int = BLOCK_BYTES, drop_rows: int = 1_000_000) -> DataFrame:
    """The documents that contain no benchmark item, in their own columns.

    One block of items is one narrow pass over the documents; with several, each
    pass writes the hashes of the texts it met, and those rows go at the end.
    """
    common.prepare(spark)
    dealt, blocks = _items(spark, benchmark, item_text, block_bytes)
    at = docs.columns.index(text)

    def hit(shared, body) -> bool:
        return any(covered >= coverage * n for _, n, covered, _ in shared.value.meet(body))

    if len(blocks) < 2:

        def filtered(shared) -> DataFrame:
            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in common.sliced(batches, at):
                    keep = [not hit(shared, body) for body in batch.column(at).to_pylist()]
                    yield batch if all(keep) else batch.filter(pa.array(keep, pa.bool_()))

            return docs.mapInArrow(run, docs.schema)

        return next(iter(_passes(spark, dealt, blocks, min_match, filtered)), docs)

    def marked(shared) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in common.sliced(batches, 1):
                yield batch.select(["h"]).filter(pa.array([hit(shared, body) for body in batch.column(1).to_pylist()], pa.bool_()))

        body = F.col(text).cast("string")
        return docs.select(F.xxhash64(body).alias("h"), body.alias("text")).mapInArrow(run, "h long")

    marks = reduce(DataFrame.unionByName, _passes(spark, dealt, blocks, min_match, marked))
    return common.without_rows(docs, marks, {"h": F.xxhash64(F.col(text).cast("string"))}, drop_rows)
