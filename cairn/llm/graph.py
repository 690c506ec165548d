"""Connected components of a link table, without collecting links or nodes anywhere."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm import common

#: Links that a task turns into stars at a time, 16 MB (about 130 MB at work).
AT_ONCE = 1_000_000
#: Links up to which the least neighbours of all nodes are broadcast.
FEW_LINKS = 500_000


def local_stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The components of these links alone: every node but the smallest ones, with its component's smallest."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low, now = np.minimum(root[x], root[y]), root.copy()
        np.minimum.at(now, root[x], low)
        np.minimum.at(now, root[y], low)
        while (now[now] != now).any():
            now = now[now]
        if (now == root).all():
            hung = np.flatnonzero(root != np.arange(len(nodes)))
            return nodes[hung], nodes[root[hung]]
        root = now


def _contracted(links: DataFrame, at_once: int) -> DataFrame:
    """Links (a, b), a > b, that connect the same nodes: stars of each task's links, as many rows at most as there were."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in chain(batches, (None,)):
            if batch is not None:
                held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
                n += batch.num_rows
            if n and (batch is None or n >= at_once):
                node, root = local_stars(*(np.concatenate(c) for c in zip(*held)))
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], ["a", "b"])
                held, n = [], 0

    return links.filter("a <> b").select("a", "b").mapInArrow(run, "a long, b long")


def components(spark: SparkSession, links: DataFrame, *, at_once: int = AT_ONCE, few_links: int = FEW_LINKS) -> DataFrame:
    """``links(a long, b long)``, a table that is cheap to read -> (node, root): every linked node but the roots, with its component's smallest node.

    Up to ``at_once`` links (counted) are one task's share, which turns them into
    stars.  More are first contracted so by each task; then come alternating
    large-star and small-star rounds, each followed by the same, until what they
    leave is one task's share or settled.  A star is an aggregation and a join on
    node, so a node with very many links is pre-aggregated on the map side, and
    its join is a broadcast one for up to ``few_links`` links, beyond which its
    partition can be split.  Every round is written to the shared folder, and the
    one before it is removed.
    """

    def stars(edges: DataFrame, large: bool, small_table: bool) -> DataFrame:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if large:
            both = both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        joined = both.join(F.broadcast(least) if small_table else least, "u")
        if large:
            out = joined.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            out = joined.filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        return out.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def done(edges: DataFrame) -> bool:
        """No node hangs on two rows, and none that hangs on one is another's: what a further round would leave as it is."""
        ends = edges.select(F.col("a").alias("u"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("b").alias("u"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        ends = ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        return ends.filter("up + down > 1 AND up > 0").isEmpty()

    n, edges, before = links.count(), links, None
    while n > at_once:
        if before is not None and done(edges):
            break
        few = n <= few_links
        more = _contracted(edges, at_once) if before is None else _contracted(stars(stars(edges, True, few), False, few), at_once).distinct()
        before, edges = edges, common.written(spark, more, "links")
        if before is not links:
            common.drop(before)
        n = edges.count()
    else:
        before, edges = edges, common.written(spark, _contracted(edges.coalesce(1), at_once), "links")
        if before is not links:
            common.drop(before)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
