"""The folder that the driver and all executors see."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}
_FOLDERS: dict[str, str] = {}


def folder(spark: SparkSession) -> str:
    """The one that ``spark.checkpoint.dir`` names; a private one only where that is unset on a local master (tests)."""
    place = spark.conf.get("spark.checkpoint.dir", None)
    if not place:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors see")
        app = spark.sparkContext.applicationId
        if app not in _OWN:
            _OWN[app] = "file://" + tempfile.mkdtemp(prefix="cairn-checkpoint-")
        place = _OWN[app]
    return place.rstrip("/")


def fresh_path(spark: SparkSession, tag: str) -> str:
    """A new path in the application's own part of the shared folder, which goes when the application ends."""
    app = spark.sparkContext.applicationId
    if app not in _FOLDERS:
        own = f"{folder(spark)}/cairn-{app}-{uuid.uuid4().hex[:8]}"
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(own)
        fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        fs.mkdirs(where)
        fs.deleteOnExit(where)
        _FOLDERS[app] = own
    return f"{_FOLDERS[app]}/{tag}-{uuid.uuid4().hex}"


def written(spark: SparkSession, df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: it is never computed, or dealt, twice."""
    path = fresh_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
