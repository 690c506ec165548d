"""Give executors this package where their Python path has not got it."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_SHIPPED: set[str] = set()


def ensure(spark: SparkSession) -> None:
    """Once for each application, unless PYTHONPATH or the working folder provides the package."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    _SHIPPED.add(app)
    known = {os.path.realpath(p) for p in filter(None, os.environ.get("PYTHONPATH", "").split(os.pathsep))}
    if ROOT in known or os.path.exists(os.path.join(os.getcwd(), "cairn")) or not os.path.isdir(ROOT):
        return
    spark.sparkContext.addPyFile(shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="cairn-"), "cairn"), "zip", ROOT, "cairn"))
