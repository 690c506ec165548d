"""Bounded heavy hitters with error bounds (D19): mergeable counters, one for each task, merged in a tree.

A counter holds at most ``capacity`` keys of each group.  With each it keeps what
the key has surely been counted (``low``), what it can have been counted at most
(``high``) and its weight in the counter (``kept``); ``floor`` bounds every key that it
has not.  Merging adds them up, a key that one side has not being at most that
side's floor there; if too many keys are left, the first weight beyond the
capacity is taken from all, keys without any weight left go, and the floor rises
by it.  Every cut takes its amount from more than ``capacity`` keys, so the floor is
below rows / capacity: a key above that is always there, and for all of them
``count - error <= true count <= count``.

Memory: a task holds one counter and one batch.  What is shuffled is at most
``capacity`` rows for each task and group, ``FAN`` tasks to a counter in each level
of the tree.  The result doesn't depend on exact counts of all keys.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn import shared, shipping

CAPACITY = 2_000
#: Counters that are merged into one in each level.
FAN = 16
_COUNTS = "_kept long, _low long, _high long, _floor long"


class Counter:
    """Keys of every group with their bounds; ``table`` has columns keys, _kept, _low, _high."""

    def __init__(self, keys: Sequence[str], by: Sequence[str], capacity: int):
        self.keys, self.by, self.capacity = list(keys), list(by), capacity
        self.table: pd.DataFrame | None = None
        self.floor: dict[tuple, int] = {}

    def _group(self, table: pd.DataFrame) -> list[tuple]:
        return list(table[self.by].itertuples(index=False, name=None)) if self.by else [()] * len(table)

    def _floors(self, table: pd.DataFrame, floors: dict[tuple, int]) -> np.ndarray:
        return np.array([floors.get(g, 0) for g in self._group(table)], dtype=np.int64)

    def merge(self, other: pd.DataFrame, floors: dict[tuple, int]) -> None:
        """Take another counter's table; an exact count is one whose floors are zero."""
        if self.table is None:
            both, self.floor = other, dict(floors)
        else:
            mine, theirs = self.table.assign(_side=0), other.assign(_side=1)
            # a key is at most the floor of the side that has not got it
            mine["_high"] += self._floors(mine, floors)
            theirs["_high"] += self._floors(theirs, self.floor)
            rows = pd.concat([mine, theirs])
            both = rows.groupby(self.keys, dropna=False, sort=False).agg(_kept=("_kept", "sum"), _low=("_low", "sum"), _high=("_high", "sum"), _n=("_side", "size")).reset_index()
            twice = both["_n"].to_numpy() == 2
            if twice.any():  # it has both sides' own counts, so neither floor
                extra = self._floors(both, floors) + self._floors(both, self.floor)
                both["_high"] = np.where(twice, both["_high"] - extra, both["_high"])
            both = both.drop(columns="_n")
            for group, n in floors.items():
                self.floor[group] = self.floor.get(group, 0) + n
        self.table = self._cut(both)

    def _cut(self, table: pd.DataFrame) -> pd.DataFrame:
        if len(table) <= self.capacity:
            return table
        parts = []
        for group, part in table.groupby(self.by, dropna=False, sort=False) if self.by else [((), table)]:
            if len(part) > self.capacity:
                beyond = int(np.partition(part["_kept"].to_numpy(), len(part) - 1 - self.capacity)[len(part) - 1 - self.capacity])
                part = part.assign(_kept=part["_kept"] - beyond)
                part = part[part["_kept"] > 0]
                group = tuple(None if pd.isna(g) else g for g in group)
                self.floor[group] = self.floor.get(group, 0) + beyond
            parts.append(part)
        return pd.concat(parts)

    def floors_of(self, table: pd.DataFrame) -> np.ndarray:
        return self._floors(table, self.floor)


def _counted(batch: pa.RecordBatch, keys: Sequence[str]) -> pd.DataFrame:
    table = pa.Table.from_batches([batch]).group_by(list(keys)).aggregate([([], "count_all")]).to_pandas(integer_object_nulls=True)
    n = table.pop("count_all").to_numpy(dtype=np.int64)
    return table.assign(_kept=n, _low=n, _high=n)


def _rows(counter: Counter, task: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The counter's rows; one more without a key carries the floor of a group that has lost all its keys."""
    if counter.table is None:
        return
    out = counter.table.assign(_task=task, _floor=counter.floors_of(counter.table), _key=True)
    alone = [g for g, n in counter.floor.items() if n and g not in set(counter._group(counter.table))]
    if alone:
        more = pd.DataFrame([{**dict(zip(counter.by, g)), "_task": task, "_floor": counter.floor[g], "_key": False, "_kept": 0, "_low": 0, "_high": 0} for g in alone])
        out = pd.concat([out, more])
    yield from pa.Table.from_pandas(out.reindex(columns=schema.names), schema=schema, preserve_index=False).to_batches()


def heavy_hitters(df: DataFrame, keys: Sequence[str], k: int, *, by: Sequence[str] = (), capacity: int = CAPACITY, fan: int = FAN) -> DataFrame:
    """The k most frequent keys of each group with ``n`` and ``error``: n - error <= true count <= n.  Ties by key; null is a key.

    ``keys`` includes ``by``.  An empty table gives an empty result.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark, keys, by = df.sparkSession, list(dict.fromkeys([*by, *keys])), list(by)
    shipping.ensure(spark)
    source = df.select(*keys)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema)
    made = f"{kinds}, {_COUNTS}, _key boolean, _task int"
    schema = to_arrow_schema(spark.createDataFrame([], made).schema)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(keys, by, capacity)
        for batch in batches:
            if batch.num_rows:
                counter.merge(_counted(batch, keys), {})
        yield from _rows(counter, TaskContext.get().partitionId(), schema)

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come in order of their counter (``_task``) inside the one they merge into (``_to``)."""
        held: list[pa.RecordBatch] = []
        target, counter = None, None

        def take(rows: pd.DataFrame) -> None:
            floors = {g: int(n) for g, n in zip(counter._group(rows), rows["_floor"]) if n}
            counter.merge(rows[rows["_key"]][[*keys, "_kept", "_low", "_high"]], floors)

        for batch in (*batches, None):
            if batch is not None:
                held.append(batch)
            rows = pa.Table.from_batches(held).to_pandas(integer_object_nulls=True) if held else pd.DataFrame({"_to": [], "_task": []})
            ends = len(rows) if batch is None else int((rows["_task"] != rows["_task"].iloc[-1]).sum()) if len(rows) else 0
            for (to, _), part in rows.iloc[:ends].groupby(["_to", "_task"], sort=True):
                if to != target:
                    if counter is not None:
                        yield from _rows(counter, int(target), schema)
                    target, counter = to, Counter(keys, by, capacity)
                take(part)
            held = [pa.RecordBatch.from_pandas(rows.iloc[ends:], schema=held[0].schema, preserve_index=False)] if held and ends < len(rows) else []
        if counter is not None:
            yield from _rows(counter, int(target), schema)

    counters = shared.written(spark, source.mapInArrow(build, made), "counters")
    while (counters.agg(F.max("_task")).first()[0] or 0) > 0:  # the number of tasks, ``fan`` times smaller each time
        dealt = counters.withColumn("_to", F.floor(F.col("_task") / fan).cast("int")).repartition("_to").sortWithinPartitions("_to", "_task")
        counters = shared.written(spark, dealt.mapInArrow(together, made), "counters")
    high = F.least(F.col("_high"), F.col("_low") + F.col("_floor"))
    found = counters.filter("_key").select(*keys, high.alias("n"), (high - F.col("_low")).alias("error"))
    order = [F.desc("n"), *[F.asc_nulls_last(c) for c in keys]]
    if not by:
        return found.orderBy(*order).limit(k)
    from cairn.operators.reduce import top_k

    return top_k(found, by, order, k).drop("rank")
