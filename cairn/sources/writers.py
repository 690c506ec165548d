"""Sinks (S1..S9): partitioned and compressed tables, single files with headers, splits, views."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from cairn.sources.readers import SourceError, _fs


def write_table(df: DataFrame, path: str, *, fmt: str = "parquet", mode: str = "errorifexists", partition_by: Sequence[str] = (), codec: str = "snappy", order: Sequence[str] = ()) -> str:
    """A work table; appendable, optionally partitioned, sorted inside files."""
    if order:
        df = df.sortWithinPartitions(*order)
    writer = df.write.mode(mode).option("compression", "none" if fmt == "csv" and codec == "snappy" else codec)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.format(fmt).save(path)
    return path


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int, *, path: str | None = None) -> str:
    """A table whose joins on ``keys`` need no shuffle, and no sort where each bucket is one file."""
    writer = df.write.bucketBy(buckets, keys[0], *keys[1:]).sortBy(keys[0], *keys[1:]).mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return table


def write_one_csv(spark: SparkSession, df: DataFrame, path: str, order: Sequence[str] = ()) -> str:
    """One CSV file in order, header included even for no rows; written aside, then renamed.

    For reports: one task writes the file, so the rows must be few.
    """
    aside = f"{path}.writing"
    rows = df.orderBy(*order) if order else df
    if rows.isEmpty():
        rows = spark.createDataFrame([tuple(df.columns)], ", ".join(f"`c{i}` string" for i in range(len(df.columns))))
        rows.coalesce(1).write.mode("overwrite").option("header", False).csv(aside)
    else:
        rows.coalesce(1).write.mode("overwrite").option("header", True).csv(aside)
    fs, where = _fs(spark, aside)
    part = next(s.getPath() for s in fs.listStatus(where) if s.getPath().getName().startswith("part-"))
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs.delete(target, True)
    if not fs.rename(part, target):
        raise SourceError(f"could not publish {path}")
    fs.delete(where, True)
    return path


def split_csv(df: DataFrame, path: str, rows_per_file: int) -> str:
    """CSV files of at most so many rows, each with the header."""
    df.write.option("header", True).option("maxRecordsPerFile", rows_per_file).csv(path)
    return path


def register(frames: Mapping[str, DataFrame]) -> None:
    """Temporary views for SQL users."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def unique_ids(df: DataFrame, key: str, path: str) -> str:
    df.select(key).where(df[key].isNotNull()).distinct().write.mode("append").parquet(path)
    return path


def pre_head(spark: SparkSession, root: str, outputs: Mapping[str, Sequence[str]]) -> None:
    """A folder for each named output with a file that has the header alone, so that an empty output has its columns too."""
    for name, columns in outputs.items():
        _put_text(spark, f"{root}/{name}/header.csv", ",".join(columns) + "\n")


def append_rows(df: DataFrame, path: str, columns: Sequence[str]) -> str:
    """Append rows to a pre-headed output, in its order of columns; every file has the header."""
    df.select(*columns).write.mode("append").option("header", True).csv(path)
    return path


def write_batches(df: DataFrame, path: str, rows: int, writers: int = 8) -> str:
    """Many small pieces as fewer files of at most ``rows`` rows, about as full as can be."""
    df.coalesce(writers).write.option("maxRecordsPerFile", rows).parquet(path)
    return path


class PartitionStore:
    """A store that takes frames until it is sealed, dealt by key, so that keys are looked up in their partitions alone."""

    def __init__(self, spark: SparkSession, path: str, key: str, partitions: int):
        self.spark, self.path, self.key, self.partitions = spark, path, key, partitions

    def _part(self, column):
        from cairn.functions.scalar import bucket

        return bucket(column, self.partitions)

    @property
    def sealed(self) -> bool:
        fs, mark = _fs(self.spark, f"{self.path}/sealed.json")
        return fs.exists(mark)

    def add(self, df: DataFrame) -> None:
        if self.sealed:
            raise SourceError(f"{self.path} is sealed")
        df.withColumn("_part", self._part(df[self.key])).write.mode("append").partitionBy("_part").parquet(f"{self.path}/rows")

    def seal(self) -> None:
        if self.sealed:
            raise SourceError(f"{self.path} is sealed")
        counts = self.spark.read.parquet(f"{self.path}/rows").groupBy("_part").count().collect()  # a row for each partition
        _put_text(self.spark, f"{self.path}/sealed.json", json.dumps({str(r["_part"]): r["count"] for r in counts}, sort_keys=True))

    def read(self) -> DataFrame:
        if not self.sealed:
            raise SourceError(f"{self.path} is not sealed")
        return self.spark.read.parquet(f"{self.path}/rows")

    def rows_of(self, keys: DataFrame) -> DataFrame:
        """All rows of the keys; partition and key meet the store's, so its partitions are pruned."""
        wanted = keys.select(self.key).distinct().withColumn("_part", self._part(keys[self.key]))
        return self.read().join(wanted, [self.key, "_part"], "left_semi").drop("_part")


def _put_text(spark: SparkSession, path: str, text: str) -> None:
    fs, where = _fs(spark, path)
    out = fs.create(where, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def publish(spark: SparkSession, staging: str, target: str, *, fail_after: str | None = None) -> str:
    """Replace ``target`` by a finished ``staging`` folder.

    A journal beside the target names both folders before anything moves, and
    goes when all is done; ``recover`` finishes or undoes what a crash left.
    Nothing is deleted while the journal's new copy isn't in its place.
    ``fail_after`` ("staged", "moved" or "placed") breaks off there, for tests.
    """
    recover(spark, target)
    fs, new = _fs(spark, staging)
    if not fs.exists(new):
        raise SourceError(f"nothing staged at {staging}")
    _put_text(spark, f"{target}.journal", json.dumps({"staging": staging, "had": fs.exists(_fs(spark, target)[1])}))
    return _place(spark, target, fail_after)


def _place(spark: SparkSession, target: str, fail_after: str | None = None) -> str:
    fs, old = _fs(spark, target)
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    journal = json.loads(spark.read.text(f"{target}.journal", wholetext=True).first()[0])
    new, aside = Path(journal["staging"]), Path(f"{target}.previous")

    def reached(step: str) -> None:
        if fail_after == step:
            raise InterruptedError(step)

    reached("staged")
    if fs.exists(new):  # else it is in its place already
        if fs.exists(old) and not fs.exists(aside) and not fs.rename(old, aside):
            raise SourceError(f"could not set {target} aside")
        reached("moved")
        if fs.exists(old) or not fs.rename(new, old):
            raise SourceError(f"could not publish {target}")
    reached("placed")
    fs.delete(aside, True)
    fs.delete(Path(f"{target}.journal"), False)
    return target


def recover(spark: SparkSession, target: str, *, finish: bool = True) -> bool:
    """Finish a publication that broke off, or undo it where that is asked for and the new copy isn't in place yet; whether there was one."""
    fs, old = _fs(spark, target)
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    journal, aside = Path(f"{target}.journal"), Path(f"{target}.previous")
    if not fs.exists(journal):
        return False
    staged = Path(json.loads(spark.read.text(f"{target}.journal", wholetext=True).first()[0])["staging"])
    if finish or not fs.exists(staged):
        _place(spark, target)
        return True
    if fs.exists(aside) and not fs.exists(old):
        fs.rename(aside, old)
    fs.delete(journal, False)
    return True


def refuse_inside_worktree(path: str) -> str:
    """Row-level output must not lie in a version-controlled folder."""
    import os

    here = os.path.abspath(path.removeprefix("file://"))
    while True:
        if os.path.exists(os.path.join(here, ".git")):
            raise SourceError(f"{path} is inside the Git worktree {here}")
        up = os.path.dirname(here)
        if up == here:
            return path
        here = up
