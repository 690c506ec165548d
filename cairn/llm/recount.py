"""Edit-aware token counting (operator 8).

A document is cut into leaves of about ``LEAF`` characters, at places where a
pre-token of the vocabulary file always ends: before white space, before a digit,
and between a letter and a punctuation mark.  So a document's count is the sum
of its leaves', and a text without white space has small leaves too; only one
unbroken run of letters, or of symbols, is never cut.  A segment tree over the
leaves keeps each subtree's characters and tokens.  An edit finds its leaves by
descending on characters; only those, and the neighbours at the edit's edges, are
cut and encoded again, and the sums above them are updated.  Leaves are split
when they have grown and joined when they have shrunk; then the sums (numbers,
no text) are built anew.

``build`` makes the trees of a table, ``apply_edits`` brings trees and texts up
to date with a table of edits, ``revise`` does both in one pass for edits that
a function of the text gives.

Scale: building and revising are narrow passes that encode all leaves of a slice
of documents in one call, and again all regions of a round of edits.  Edits are
grouped by document (a document's edits are one list, as it is edited in one
place) and meet texts and trees in joins by key.

Defined results: null text counts as empty; edits reach into the text as far as
it goes (places beyond its end are its end); null keys are carried by ``build``
and ``revise`` and have no edits; repeated documents are each counted; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm import common, tokens

LEAF = 256
Edit = tuple[int, int, str]  # start, stop (exclusive), replacement; places in the text as it then is

#: Marks that begin a pre-token after a letter (the apostrophe may be part of a contraction, the bar of a special token).
_MARK = r",.;:()\[\]{}=+*&/?!\"，。、；：？！"
#: A leaf goes on to the next place where it may end.
_LEAF = {n: re.compile(rf"(?s).{{1,{n}}}(?:(?<![A-Za-z])[{_MARK}]|[^\s0-9{_MARK}]+)*") for n in (LEAF,)}


def cut_leaves(text: str, leaf: int = LEAF) -> list[str]:
    """Parts of about ``leaf`` characters, whose tokens are those of the text."""
    if leaf not in _LEAF:
        _LEAF[leaf] = re.compile(_LEAF[LEAF].pattern.replace(f"{{1,{LEAF}}}", f"{{1,{leaf}}}"))
    return _LEAF[leaf].findall(text) or [""]


class SegmentTree:
    """Leaves of one document with subtree sums of characters and tokens."""

    def __init__(self, leaves: list[str], counts: list[int]):
        self.leaves, self.counts = leaves, list(counts)
        self.encoded_chars = 0
        self._sum()

    def _sum(self) -> None:
        n = len(self.leaves)
        self.size = 1 << (n - 1).bit_length() if n else 1
        self.chars = [0] * self.size + [len(x) for x in self.leaves] + [0] * (self.size - n)
        self.tokens = [0] * self.size + self.counts + [0] * (self.size - n)
        for i in range(self.size - 1, 0, -1):
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    def text(self) -> str:
        return "".join(self.leaves)

    def _find(self, place: int) -> tuple[int, int]:
        """The leaf that holds the character at ``place`` (the last one for the end), and its begin."""
        place_in, node, begin = min(place, self.n_chars - 1), 1, 0
        while node < self.size:
            node *= 2
            if place_in - begin >= self.chars[node]:
                begin += self.chars[node]
                node += 1
        return node - self.size, begin

    def cut(self, start: int, stop: int, new: str) -> tuple[int, int, list[str]]:
        """What an edit makes of which leaves: (first leaf, leaf after the last, the leaves that replace them)."""
        start = max(0, min(start, self.n_chars))
        stop = max(start, min(stop, self.n_chars))
        if not self.n_chars:
            return 0, len(self.leaves), cut_leaves(new)
        first, begin = self._find(start)
        last, _ = self._find(max(start, stop - 1))
        if first > 0 and start == begin:  # the edit meets the leaf's first character: what stands before takes part
            first -= 1
            begin -= len(self.leaves[first])
        if last + 1 < len(self.leaves):
            last += 1
        region = "".join(self.leaves[first : last + 1])
        region = region[: start - begin] + new + region[stop - begin :]
        if len(region) < LEAF // 4 and first > 0:  # hardly anything left: it joins the leaf before
            first -= 1
            region = self.leaves[first] + region
        return first, last + 1, cut_leaves(region)

    def put(self, first: int, after: int, parts: list[str], counts: list[int]) -> None:
        """Replace the leaves; as many as before update the sums above them, else all sums are built anew."""
        self.encoded_chars += sum(map(len, parts))
        if len(parts) > 1 or after - first < len(self.leaves):
            kept = [(p, n) for p, n in zip(parts, counts) if p]
            parts, counts = [p for p, _ in kept], [n for _, n in kept]
        self.leaves[first:after], self.counts[first:after] = parts, counts
        if not self.leaves:
            self.leaves, self.counts = [""], [0]
        if len(parts) != after - first:
            return self._sum()
        for number in range(first, after):
            node = number + self.size
            self.chars[node], self.tokens[node] = len(self.leaves[number]), self.counts[number]
        low, high = (first + self.size) // 2, (after - 1 + self.size) // 2
        while low >= 1:
            for node in range(low, high + 1):
                self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
                self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]
            low, high = low // 2, high // 2

    def edit(self, start: int, stop: int, new: str, count: Callable[[list[str]], list[int]]) -> None:
        first, after, parts = self.cut(start, stop, new)
        self.put(first, after, parts, count(parts))


def trees_of(enc: tokens.WordEncoder, texts: list[str | None]) -> list[SegmentTree]:
    """The trees of several texts, whose leaves are all encoded in one call."""
    cut = [cut_leaves(t or "") for t in texts]
    counts, at, trees = enc.count_many([leaf for leaves in cut for leaf in leaves]), 0, []
    for leaves in cut:
        trees.append(SegmentTree(leaves, counts[at : at + len(leaves)]))
        at += len(leaves)
    return trees


def edit_all(enc: tokens.WordEncoder, trees: list[SegmentTree], edits: list[list[Edit]]) -> None:
    """Each tree's edits in their order; the regions of all trees' n-th edits are encoded in one call."""
    for turn in range(max(map(len, edits), default=0)):
        todo = [(tree, tree.cut(*own[turn])) for tree, own in zip(trees, edits) if turn < len(own)]
        counts, at = enc.count_many([part for _, (*_, parts) in todo for part in parts]), 0
        for tree, (first, after, parts) in todo:
            tree.put(first, after, parts, counts[at : at + len(parts)])
            at += len(parts)


TREE = "leaf_chars array<int>, leaf_tokens array<int>, n_tokens long"


def build(docs: DataFrame, *, key: str = "doc_id", text: str = "text", tokenizer: str | None = None) -> DataFrame:
    """(doc_id, leaf_chars, leaf_tokens, n_tokens): each document's tree, as its leaves from left to right."""
    common.prepare(docs.sparkSession)
    path = tokenizer or tokens.vocab_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokens.encoder(path)
        for batch in common.sliced(batches, 1):
            trees = trees_of(enc, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([[len(x) for x in t.leaves] for t in trees], pa.list_(pa.int32())), pa.array([t.counts for t in trees], pa.list_(pa.int32())), pa.array([t.n_tokens for t in trees], pa.int64())],
                ["doc_id", "leaf_chars", "leaf_tokens", "n_tokens"],
            )

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, f"doc_id long, {TREE}")


def apply_edits(docs: DataFrame, trees: DataFrame, edits: DataFrame, *, key: str = "doc_id", text: str = "text", tokenizer: str | None = None) -> DataFrame:
    """Edited documents only: (doc_id, text, leaf_chars, leaf_tokens, n_tokens, encoded_chars).

    ``edits``: (doc_id, seq, start, stop, new), applied in the order of ``seq``.
    """
    common.prepare(docs.sparkSession)
    path = tokenizer or tokens.vocab_path()
    lists = edits.filter("doc_id is not null").groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("seq", "start", "stop", "new"))).alias("edits"))
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), common.text_or_empty(text).alias("text")).join(lists, "doc_id").join(trees.select("doc_id", "leaf_chars", "leaf_tokens"), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokens.encoder(path)
        for batch in common.sliced(batches, "text"):
            cells = {c: batch.column(c).to_pylist() for c in ("doc_id", "text", "edits", "leaf_chars", "leaf_tokens")}
            trees = []
            for body, chars, counts in zip(cells["text"], cells["leaf_chars"], cells["leaf_tokens"]):
                ends = list(accumulate(chars))
                trees.append(SegmentTree([body[z - n : z] for n, z in zip(chars, ends)], counts))
            edit_all(enc, trees, [[(e["start"], e["stop"], e["new"] or "") for e in todo] for todo in cells["edits"]])
            out = [cells["doc_id"], [t.text() for t in trees], [[len(x) for x in t.leaves] for t in trees], [t.counts for t in trees], [t.n_tokens for t in trees], [t.encoded_chars for t in trees]]
            types = (pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], ["doc_id", "text", "leaf_chars", "leaf_tokens", "n_tokens", "encoded_chars"])

    return rows.mapInArrow(run, f"doc_id long, text string, {TREE}, encoded_chars long")


def spread_edits(text: str) -> list[Edit]:
    """Three edits of any text: cut a word out at a quarter, put one in at half, replace a character at three quarters."""
    n = len(text)
    if not n:
        return [(0, 0, "added")]
    quarter = n // 4
    end = text.find(" ", quarter)
    end = n if end < 0 else end
    left = n - (end - quarter)
    return [(quarter, end, ""), (left // 2, left // 2, " added"), ((left + 6) * 3 // 4, (left + 6) * 3 // 4 + 1, "-")]


def revise(docs: DataFrame, edits_of: Callable[[str], list[Edit]] = spread_edits, *, key: str = "doc_id", text: str = "text", tokenizer: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, n_tokens_edited, n_chars_edited, encoded_chars): counts before and after the edits, in one pass."""
    common.prepare(docs.sparkSession)
    path = tokenizer or tokens.vocab_path()
    names = ["doc_id", "n_tokens", "n_tokens_edited", "n_chars_edited", "encoded_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokens.encoder(path)
        for batch in common.sliced(batches, 1):
            texts = batch.column(1).to_pylist()
            trees = trees_of(enc, texts)
            before = [t.n_tokens for t in trees]
            edit_all(enc, trees, [edits_of(t or "") for t in texts])
            columns = [before, [t.n_tokens for t in trees], [t.n_chars for t in trees], [t.encoded_chars for t in trees]]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in columns)], names)

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, ", ".join(f"{n} long" for n in names))
