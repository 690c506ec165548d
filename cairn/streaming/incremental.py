"""Incremental forms of the chunked reducers (I1..I6), as Structured Streaming with ``availableNow``.

Each run takes what is new, updates keyed state and ends; checkpoints make a
rerun resume.  Keep-first state is one row per key, so it grows with keys, not
with events.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import StructType

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def source(spark: SparkSession, path: str, schema, *, fmt: str = "parquet", files_per_batch: int = 8) -> DataFrame:
    """A folder as a bounded stream of files."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format(fmt).load(path)


def counts(stream: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Running counts and first moments (complete mode)."""
    return stream.groupBy(*keys).agg(F.count("*").alias("n_events"), F.min(ts).alias("first_ts"))


def windowed(stream: DataFrame, keys: Sequence[str], ts: str, *, length: str, late: str) -> DataFrame:
    """Counts in event-time windows, closed once ``late`` has passed."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, length), *keys).agg(F.count("*").alias("n_events"))


def members(stream: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each key once, over all batches."""
    return stream.select(*keys).dropDuplicates(list(keys))


class _KeepFirst(StatefulProcessor):
    """State: the earliest row of a key so far; it lies in the state store on disk, a batch's frames are looked at one by one."""

    def __init__(self, columns: Sequence[str], order: Sequence[str], schema: StructType):
        self.columns, self.order, self.schema = list(columns), list(order), schema

    def init(self, handle) -> None:
        self.first = handle.getValueState("first", self.schema)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self.first.get() if self.first.exists() else None
        best = None if held is None else pd.DataFrame([tuple(held)], columns=self.columns)
        changed = False
        for frame in rows:
            first = frame[self.columns].sort_values(self.order, kind="stable", na_position="last").head(1)
            both = first if best is None else pd.concat([best, first]).sort_values(self.order, kind="stable", na_position="last").head(1)
            changed |= best is None or tuple(both.iloc[0]) != tuple(best.iloc[0])
            best = both
        if changed:
            self.first.update(tuple(None if pd.isna(v) else (v.to_pydatetime() if isinstance(v, pd.Timestamp) else v.item() if hasattr(v, "item") else v) for v in best.iloc[0]))
            yield best

    def close(self) -> None:
        pass


def keep_first(stream: DataFrame, key: str, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The earliest row of each key so far; a row is appended when a key's earliest changes.  Needs ``run_to``, which sets the state store."""
    schema = StructType([stream.schema[c] for c in columns])
    return stream.select(*columns).groupBy(key).transformWithStateInPandas(_KeepFirst(columns, order, schema), schema, "Append", "None")


def run_once(stream: DataFrame, name: str, *, mode: str, checkpoint: str | None = None) -> DataFrame:
    """Take everything that is there into a memory table named ``name`` (for a row for each of a few keys), then stop."""
    writer = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    query = writer.start()
    query.awaitTermination()
    return stream.sparkSession.table(name)


def run_to(stream: DataFrame, path: str, checkpoint: str, *, mode: str = "append") -> None:
    """Append everything that is there to a Parquet folder, then stop; a rerun resumes.  Keyed state lies in RocksDB stores."""
    conf = stream.sparkSession.conf
    before = conf.get(_PROVIDER, None)
    conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        conf.unset(_PROVIDER) if before is None else conf.set(_PROVIDER, before)
