"""Discovery, validation and scans (A1..A19).

Listing and headers are driver-side metadata; rows are only ever read by Spark.
Paths go through Hadoop's file systems, so any store that Spark reads works.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


#: Bytes of a file up to which it is read for its first line together with all others.
SCANNED_FOR_HEADERS = 128 << 20


class SourceError(ValueError):
    """An input that can't be used: ambiguous, incomplete or of another shape."""


def _fs(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def list_files(spark: SparkSession, root: str, suffix: str = ".csv") -> list[str]:
    """All files below ``root`` with the suffix, sorted."""
    fs, where = _fs(spark, root)
    if not fs.exists(where):
        raise SourceError(f"no such folder: {root}")
    # not listFiles: on a local disk it asks the system for each file's owner by a process of its own
    found, folders = [], [where]
    while folders:
        for status in fs.listStatus(folders.pop()):
            p = status.getPath()
            if status.isDirectory():
                folders.append(p)
            elif (name := p.toString()).lower().endswith(suffix):
                found.append(name)
    return sorted(found)


_NUMBERED = re.compile(r"^(.*?)[_\- ]?(\d+)$")


def family_files(paths: Sequence[str], stem: str | None = None) -> list[str]:
    """Files of one family; when some are numbered, only those, by (prefix, number)."""
    parts = []
    for p in paths:
        name = p.rsplit("/", 1)[-1].rsplit(".", 1)[0]
        if stem and not name.lower().startswith(stem.lower()):
            continue
        m = _NUMBERED.match(name)
        parts.append((m[1], int(m[2]), p) if m else (name, None, p))
    numbered = [x for x in parts if x[1] is not None]
    chosen = sorted(numbered, key=lambda x: (x[0], x[1])) if numbered else sorted(parts)
    return [p for *_, p in chosen]


def select_family(paths: Sequence[str], stem: str) -> list[str]:
    """The family nearest the root; one unsplit file is preferred; several folders at that depth are refused."""
    mine = [p for p in paths if p.rsplit("/", 1)[-1].lower().startswith(stem.lower())]
    if not mine:
        raise SourceError(f"no files for {stem}")
    depth = min(p.count("/") for p in mine)
    mine = [p for p in mine if p.count("/") == depth]
    if len({p.rsplit("/", 1)[0] for p in mine}) > 1:
        raise SourceError(f"{stem}: files in more than one folder")
    single = [p for p in mine if p.rsplit("/", 1)[-1].rsplit(".", 1)[0].lower() == stem.lower()]
    return single or family_files(mine)


def header(spark: SparkSession, path: str, sep: str = ",") -> list[str]:
    """The first line's column names."""
    line = spark.read.text(path).limit(1).collect()
    if not line:
        return []
    return _names(line[0][0], sep)


def _names(line: str, sep: str) -> list[str]:
    return [x.strip().strip('"').lstrip("\ufeff") for x in line.split(sep)]


def _plain(path: str) -> str:
    """A path as Hadoop writes it: one slash after a scheme without a host."""
    return re.sub(r"^(\w+):///", r"\1:/", path)


def headers(spark: SparkSession, paths: Sequence[str], sep: str = ",") -> dict[str, list[str]]:
    """The column names of each path: those of all files of up to ``SCANNED_FOR_HEADERS`` bytes by one job, a larger file's (or a folder's, a pattern's) by its own."""
    if len(paths) == 1:
        return {paths[0]: header(spark, paths[0], sep)}
    # the rows of a file's beginning are one task's, in order
    lines = spark.read.text(_roots(spark, paths)).filter(F.col("_metadata.file_size") <= SCANNED_FOR_HEADERS)
    lines = lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"), "value", F.monotonically_increasing_id().alias("place"))
    found = lines.filter("at = 0").groupBy("path").agg(F.min_by("value", "place").alias("line")).collect()  # a row for each file
    first = {_plain(unquote(r["path"])): r["line"] for r in found}
    return {p: _names(first[_plain(p)], sep) if _plain(p) in first else header(spark, p, sep) for p in paths}


def _roots(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """What Spark is told to read for these files: a folder for all that it shows, so that thousands of them are listed at once; other files by themselves."""
    folders: dict[str, list[str]] = {}
    for p in paths:
        folders.setdefault(p.rpartition("/")[0], []).append(p)
    out: list[str] = []
    for folder, files in folders.items():
        whole = False
        if folder and len(files) > 1 and len(set(files)) == len(files) and not re.search(r"[\[\]{}*?\\]", folder):
            fs, shown = _fs(spark, f"{folder}/[!_.]*")
            whole = len(fs.globStatus(shown) or ()) == len(files)
        out += [folder] if whole else files
    return out


def string_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


@dataclass
class ExportReport:
    """What a header-only validation found."""

    columns: dict[str, list[str]] = field(default_factory=dict)
    errors: list[str] = field(default_factory=list)

    @property
    def ok(self) -> bool:
        return not self.errors


def validate_export(spark: SparkSession, root: str, required: Mapping[str, Sequence[str]]) -> ExportReport:
    report, files = ExportReport(), list_files(spark, root)
    for domain, columns in required.items():
        try:
            chosen = select_family(files, domain)
        except SourceError as e:
            report.errors.append(str(e))
            continue
        for path in chosen:
            names = header(spark, path)
            report.columns[path] = names
            lost = [c for c in columns if c not in names]
            if lost:
                report.errors.append(f"{path}: missing {', '.join(lost)}")
    return report


def require_columns(df: DataFrame, columns: Sequence[str], what: str = "table") -> DataFrame:
    lost = [c for c in columns if c not in df.columns]
    if lost:
        raise SourceError(f"{what}: missing {', '.join(lost)}")
    return df


def read_csv(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str] | None = None, *, sep: str = ",") -> DataFrame:
    """CSV files as strings, by name: files with equal headers are one scan, absent columns are null, and ``_file`` names the source.

    Spark matches CSV columns by position, so files are grouped by their headers
    first, all headers by one job; short rows are padded with nulls.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    groups: dict[tuple[str, ...], list[str]] = {}
    named = headers(spark, paths, sep) if paths else {}
    for p in paths:
        groups.setdefault(tuple(named[p]), []).append(p)
    out = None
    for names, files in groups.items():
        part = spark.read.schema(string_schema(names)).option("header", True).option("sep", sep).option("mode", "PERMISSIVE").option("enforceSchema", True).option("emptyValue", "").option("nullValue", "").csv(_roots(spark, files))
        part = part.withColumn("_file", F.col("_metadata.file_path"))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise SourceError("no files")
    if columns is not None:
        out = out.select(*[F.col(c) if c in out.columns else F.lit(None).cast("string").alias(c) for c in columns], "_file")
    return out


def project(df: DataFrame, required: Sequence[str], optional: Sequence[str] = ()) -> DataFrame:
    """Required columns, and optional ones as typed nulls where they are absent."""
    require_columns(df, required)
    return df.select(*required, *[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in optional])


def read_parquet(spark: SparkSession, paths: str | Sequence[str], *, merge: bool = True) -> DataFrame:
    """Parquet files whose columns are united by name; no partition columns are inferred from folder names."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.option("mergeSchema", merge).parquet(*paths)


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None, casts: Mapping[str, str] = {}) -> DataFrame:  # noqa: B006
    """A work table in either format with pruning and casts; ``path`` may leave the suffix open."""
    df = None
    for suffix in ("", ".parquet", ".csv"):
        fs, where = _fs(spark, path + suffix)
        if fs.exists(where):
            full = path + suffix
            df = spark.read.option("header", True).csv(full) if full.endswith(".csv") else spark.read.parquet(full)
            break
    if df is None:
        raise SourceError(f"no table at {path}")
    if columns is not None:
        df = require_columns(df, columns, path).select(*columns)
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in casts.items() if c in df.columns})


def available_columns(names: Sequence[str], required: Sequence[str], optional: Sequence[str]) -> list[str]:
    lost = [c for c in required if c not in names]
    if lost:
        raise SourceError(f"missing {', '.join(lost)}")
    return [*required, *[c for c in optional if c in names]]


def inventory(spark: SparkSession, root: str, pattern: str = "*.csv") -> DataFrame:
    """Path, bytes and SHA-256 of every file; computed on the executors."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """(name, bytes, sha256) of a table's part files."""
    found = inventory(spark, path, "part-*")
    return found.select(F.element_at(F.split("path", "/"), -1).alias("name"), "bytes", "sha256")


def read_checked(spark: SparkSession, path: str, expected: DataFrame, *, attempts: int = 2) -> DataFrame:
    """A Parquet table whose files are those of ``expected``; read once more before it is refused."""
    for _ in range(attempts):
        now = checksums(spark, path)
        differs = expected.exceptAll(now).unionByName(now.exceptAll(expected))
        if differs.isEmpty():
            return spark.read.parquet(path)
    raise SourceError(f"{path}: its files are not those of its checksums")


def row_counts(df: DataFrame) -> DataFrame:
    """Rows of each source file of a scan that kept ``_file``."""
    return df.groupBy("_file").agg(F.count("*").alias("rows"))


def read_subjects(df: DataFrame, key: str) -> DataFrame:
    """Demographics, refused when a subject has several rows."""
    from cairn.operators.guards import unique

    return unique(df, [key], "subjects")


def open_product(spark: SparkSession, path: str, *, expected_schema_sha256: str | None = None) -> dict[str, DataFrame]:
    """A published product's tables, after its manifest and schema digest are checked."""
    from cairn.sources.manifests import read_manifest

    manifest = read_manifest(spark, path)
    if expected_schema_sha256 and manifest["schema_sha256"] != expected_schema_sha256:
        raise SourceError(f"{path}: the schema is another one")
    return {name: spark.read.parquet(f"{path}/{name}") for name in manifest["tables"]}
