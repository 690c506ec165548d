"""Manifests, data dictionaries and comparisons (L1, L2, L9..L13, K34)."""

from __future__ import annotations

import hashlib
import json
import platform
import time
from collections.abc import Callable, Mapping, Sequence

import pyspark
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.operators.aggregate import table_hash
from cairn.sources.readers import SourceError, _fs

VERSION = "1"


def schema_digest(tables: Mapping[str, DataFrame]) -> str:
    text = json.dumps({n: [(f.name, f.dataType.simpleString()) for f in df.schema.fields] for n, df in sorted(tables.items())}, sort_keys=True)
    return hashlib.sha256(text.encode()).hexdigest()


def identity(**parts: object) -> str:
    """Digest of configuration, inputs, catalog and engine version."""
    parts |= {"engine": VERSION, "spark": pyspark.__version__, "python": platform.python_version()}
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, where = _fs(spark, path)
    out = fs.create(where, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _read_text(spark: SparkSession, path: str) -> str:
    rows = spark.read.text(path, wholetext=True).collect()
    return rows[0][0] if rows else ""


def write_manifest(spark: SparkSession, path: str, tables: Mapping[str, DataFrame], **facts: object) -> dict:
    found = {}
    for name, df in sorted(tables.items()):
        r = table_hash(df).first()
        found[name] = {"rows": r["rows"], "columns": r["columns"], "digest": r["digest"]}
    manifest = {"version": VERSION, "schema_sha256": schema_digest(tables), "tables": found, "facts": {k: str(v) for k, v in facts.items()}}
    _write_text(spark, f"{path}/manifest.json", json.dumps(manifest, sort_keys=True, indent=1))
    return manifest


def read_manifest(spark: SparkSession, path: str) -> dict:
    fs, where = _fs(spark, f"{path}/manifest.json")
    if not fs.exists(where):
        raise SourceError(f"no manifest at {path}")
    return json.loads(_read_text(spark, f"{path}/manifest.json"))


def compare_manifests(left: dict, right: dict) -> dict[str, list[str]]:
    """Missing, extra and differing tables (by digest, row count or columns)."""
    a, b = left["tables"], right["tables"]
    out = {"missing": sorted(a.keys() - b.keys()), "extra": sorted(b.keys() - a.keys())}
    for what, field in (("digest", "digest"), ("row_count", "rows"), ("columns", "columns")):
        out[what] = sorted(n for n in a.keys() & b.keys() if a[n][field] != b[n][field])
    return out


def stage(spark: SparkSession, path: str, key: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Build a stage's table once: reused when its recorded identity is ``key``, refused when it is another's."""
    fs, mark = _fs(spark, f"{path}.stage.json")
    if fs.exists(mark):
        done = json.loads(_read_text(spark, f"{path}.stage.json"))
        if done["key"] != key:
            raise SourceError(f"{path} was built from other inputs")
        return spark.read.parquet(path)
    began = time.time()
    build().write.mode("overwrite").parquet(path)
    _write_text(spark, f"{path}.stage.json", json.dumps({"key": key, "seconds": round(time.time() - began, 3)}))
    return spark.read.parquet(path)


def build(spark: SparkSession, root: str, phases: Mapping[str, Callable[[dict[str, DataFrame]], DataFrame]], **inputs: object) -> dict[str, DataFrame]:
    """Phases in order, each from the tables before it; a rerun with the same inputs takes up after the last finished one."""
    done: dict[str, DataFrame] = {}
    for name, phase in phases.items():
        done[name] = stage(spark, f"{root}/{name}", identity(phase=name, after=list(done), **inputs), lambda phase=phase: phase(dict(done)))
    return done


def progress(spark: SparkSession, root: str, names: Sequence[str]) -> DataFrame:
    """(stage, state, rows): what is done and what waits."""
    rows = []
    for name in names:
        fs, mark = _fs(spark, f"{root}/{name}.stage.json")
        done = fs.exists(mark)
        rows.append((name, "done" if done else "waiting", spark.read.parquet(f"{root}/{name}").count() if done else None))
    return spark.createDataFrame(rows, "stage string, state string, rows long")


def parity(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(rows, equal, missing, extra): how two results of the same columns agree, key by key."""
    values = [c for c in left.columns if c not in keys]
    a = left.select(*keys, F.struct(*values).alias("_a"), F.lit(True).alias("_l"))
    b = right.select(*keys, F.struct(*values).alias("_b"), F.lit(True).alias("_r"))
    on = [a[k].eqNullSafe(b[k]) for k in keys]
    both = a.join(b, on, "full_outer")
    return both.agg(F.count("_l").alias("rows"), F.count_if(F.col("_l") & F.col("_r") & F.col("_a").eqNullSafe(F.col("_b"))).alias("equal"), F.count_if(F.col("_r").isNull()).alias("missing"), F.count_if(F.col("_l").isNull()).alias("extra"))


def data_dictionary(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    rows = [(name, i + 1, f.name, f.dataType.simpleString(), f.nullable) for name, df in sorted(tables.items()) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "table_name string, ordinal int, column_name string, data_type string, nullable boolean")


def html_report(title: str, sections: Mapping[str, DataFrame], most: int = 200) -> str:
    """A page of small aggregate tables."""
    from html import escape

    out = [f"<!doctype html><title>{escape(title)}</title><h1>{escape(title)}</h1>"]
    for name, df in sections.items():
        rows = df.limit(most).collect()
        head = "".join(f"<th>{escape(c)}</th>" for c in df.columns)
        body = "".join("<tr>" + "".join(f"<td>{escape('' if v is None else str(v))}</td>" for v in r) + "</tr>" for r in rows)
        out.append(f"<h2>{escape(name)}</h2><table><tr>{head}</tr>{body}</table>")
    return "".join(out)
