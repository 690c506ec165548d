"""Shared helpers: the folder all executors see, written intermediates, table access."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn import shipping
from cairn.shared import fresh_path

#: Bytes of an Arrow batch on its way to a Python worker, where the session has not set its own.
ARROW_BYTES = 4 << 20
#: Spark removes the shuffle files of a query when it ends, not when the driver happens to collect its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: With that, no stage may outlive its query: its tasks would hold cores for minutes, asking for files that are gone.
#: This rule leaves stages running whose result an empty side of a join makes needless.
EXCLUDED_RULES = "spark.sql.adaptive.optimizer.excludedRules"
EMPTY_SIDES = "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"


def prepare(spark: SparkSession) -> None:
    """Executors can import the package, long texts don't pile up in one Arrow batch, and a query leaves neither shuffle files nor stages behind."""
    shipping.ensure(spark)
    for name, value in (("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES)), (SHUFFLE_CLEANUP, "true")):
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, value)
    excluded = spark.conf.get(EXCLUDED_RULES, None) or ""
    if EMPTY_SIDES not in excluded:
        spark.conf.set(EXCLUDED_RULES, ",".join(filter(None, (excluded, EMPTY_SIDES))))


def written(spark: SparkSession, df: DataFrame, tag: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    It cuts the lineage, survives lost executors and is never computed twice.
    """
    prepare(spark)
    path = path or fresh_path(spark, tag)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a superseded intermediate from the shared folder."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def drop(*tables: DataFrame) -> None:
    """Remove written tables that nothing reads any more."""
    for each in tables:
        for path in {f.rsplit("/", 1)[0] for f in each.inputFiles()}:
            drop_path(each.sparkSession, path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def input_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate; only steers task counts, never results."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().toString())


def without_rows(docs: DataFrame, out: DataFrame, keys: dict, most: int) -> DataFrame:
    """``docs`` without the rows whose values of ``keys`` (name in ``out`` -> column of ``docs``) stand in ``out``; nulls are values.

    ``out`` is broadcast if it has at most ``most`` distinct rows (counted), else joined by shuffle.
    """
    out = written(docs.sparkSession, out.select(*[F.col(c).alias(f"_out_{c}") for c in keys]).distinct(), "out")
    small = out.count() <= most
    on = [column.eqNullSafe(F.col(f"_out_{c}")) for c, column in keys.items()]
    return docs.join(F.broadcast(out) if small else out, on, "left_anti")


def few(df: DataFrame, most: int = 10_000) -> DataFrame:
    """A written table with a broadcast hint if it has at most ``most`` rows (counted)."""
    return F.broadcast(df) if df.count() <= most else df


def sliced(batches, column, most: int = 4 << 20):
    """The same rows in batches of about ``most`` bytes of ``column``, so that a task's working memory is bounded."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        if batch.num_rows < 2 or batch.column(column).nbytes <= most:
            yield batch
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype("int64")
        part = np.cumsum(size) // most
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, z in zip(cuts, cuts[1:]):
            yield batch.slice(a, z - a)
