"""Versioned rule catalogs from a folder of CSV files (A16)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

from cairn.operators.rules import MATCH_TYPES
from cairn.sources.readers import SourceError, header, list_files

# A catalog file's columns, in order.
COLUMNS = ("concept_set_id", "domain", "code_system", "code", "match_type", "include", "description", "source_authority", "source_version", "effective_start", "effective_end", "notes")
SCHEMA = "rule string, domain string, code_system string, code string, match_type string, include boolean, authority string, version string, effective_start date, effective_end date"


def _flag(text: str | None, where: str) -> bool:
    value = (text or "true").strip().lower()
    if value not in ("true", "false", "1", "0", "yes", "no"):
        raise SourceError(f"{where}: include is {text!r}")
    return value in ("true", "1", "yes")


def _day(text: str | None, where: str) -> dt.date | None:
    if not (text or "").strip():
        return None
    try:
        return dt.date.fromisoformat(text.strip())
    except ValueError:
        raise SourceError(f"{where}: {text!r} is no date") from None


def read_catalog(spark: SparkSession, folder: str, *, domains: Sequence[str] | None = None, required: Iterable[str] = ()) -> DataFrame:
    """All rules of the folder's CSV files.

    Refused: another header, an unknown match type or domain, a repeated rule,
    an empty code, a pattern that Java can't compile, an end before its start,
    a missing required set, or one all of whose rules are exclusions.
    Effective dates are kept and, as a rule matches whatever its dates, not applied.
    """
    rows, seen = [], set()
    for path in list_files(spark, folder):
        if tuple(header(spark, path)) != COLUMNS:
            raise SourceError(f"{path}: the header must be {', '.join(COLUMNS)}")
        # a catalog is configuration: some hundreds of rows
        for r in spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').schema(", ".join(f"{c} string" for c in COLUMNS)).csv(path).collect():
            where = f"{path}: {r['concept_set_id']}"
            code, kind = (r["code"] or "").strip(), (r["match_type"] or "").strip().lower()
            if not code or not (r["concept_set_id"] or "").strip():
                raise SourceError(f"{where}: empty code or set")
            if kind not in MATCH_TYPES:
                raise SourceError(f"{where}: unknown match_type {r['match_type']!r}")
            if domains is not None and r["domain"] not in domains:
                raise SourceError(f"{where}: unknown domain {r['domain']!r}")
            if kind == "regex":
                try:
                    spark.sparkContext._jvm.java.util.regex.Pattern.compile(code)
                except Exception:
                    raise SourceError(f"{where}: {code!r} is no pattern") from None
            key = (r["concept_set_id"], r["code_system"], code, kind)
            if key in seen:
                raise SourceError(f"{where}: repeated rule {key}")
            seen.add(key)
            start, end = _day(r["effective_start"], where), _day(r["effective_end"], where)
            if start and end and end < start:
                raise SourceError(f"{where}: ends before it starts")
            rows.append((r["concept_set_id"].strip(), r["domain"], r["code_system"], code, kind, _flag(r["include"], where), r["source_authority"], r["source_version"], start, end))
    for name in required:
        mine = [r for r in rows if r[0] == name]
        if not any(r[5] for r in mine):
            raise SourceError(f"required set {name} has no including rule")
    return spark.createDataFrame(rows, SCHEMA)
