"""Findings of the fourth check: no stage outlives its query, whose shuffle files go with it."""

import time

import pytest
from pyspark.sql import functions as F

from cairn.llm import common, simhash


def slowly(seconds, keep):
    def run(batches):
        for batch in batches:
            time.sleep(seconds if batch.num_rows else 0)
            yield batch if keep else batch.slice(0, 0)

    return run


@pytest.fixture
def shuffled(spark):
    """Joins by shuffle, and only the settings that ``prepare`` makes."""
    own = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false", common.EXCLUDED_RULES: None}
    before = {name: spark.conf.get(name, None) for name in own}
    for values in (own, before):
        for name, value in values.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
        if values is own:
            yield spark


def test_no_stage_outlives_its_query(shuffled):
    """One side turns out empty while the other's second stage runs; before, that went on without its files after the query."""
    common.prepare(shuffled)
    empty = shuffled.range(100, numPartitions=2).mapInArrow(slowly(2, False), "id long").groupBy("id").count()
    other = shuffled.range(1000, numPartitions=2).groupBy((F.col("id") % 100).alias("k")).agg(F.sum("id").alias("s"))
    other = other.mapInArrow(slowly(3, True), "k long, s long").groupBy("s").agg(F.min("k").alias("id"))
    assert common.written(shuffled, empty.join(other, "id", "left_semi"), "nothing").count() == 0
    assert not shuffled.sparkContext.statusTracker().getActiveJobsIds()


def test_rules_already_excluded_stay(shuffled):
    other = "org.apache.spark.sql.catalyst.optimizer.EliminateLimits"
    shuffled.conf.set(common.EXCLUDED_RULES, other)
    for _ in range(2):
        common.prepare(shuffled)
    assert shuffled.conf.get(common.EXCLUDED_RULES).split(",") == [other, common.EMPTY_SIDES]


def test_repeated_rows_of_groups_that_keep_another(spark):
    """Repeated rows are one where they are their group's smallest, and none where they aren't; null keys stay."""
    a, b = " ".join(f"w{i}" for i in range(40)), " ".join(f"v{i}" for i in range(40))
    rows = [(5, a), (5, a), (1, a), (7, b), (7, b), (9, "alone"), (None, "alone")]
    kept = simhash.keep_dissimilar(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept) == sorted([(1, a), (7, b), (9, "alone"), (0, "alone")])
