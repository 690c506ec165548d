"""Column builders for mixed-precision time: parsing, precision, windows, boundary differences (H-dt1..H-dt9)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_ONLY, TIMESTAMP = "date_only", "timestamp"
_ISO = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d+)?)?)?$"


def parse_timestamp(raw: Column) -> Column:
    """``YYYYMMDD``, ``YYYYMMDDHHMMSS`` or ISO text as a zone-less timestamp; anything else is null."""
    text = F.trim(raw)
    compact = F.when(F.length(text) == 8, F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2)))
    compact = compact.when(F.length(text) == 14, F.concat(F.substring(text, 1, 4), F.lit("-"), F.substring(text, 5, 2), F.lit("-"), F.substring(text, 7, 2), F.lit(" "), F.substring(text, 9, 2), F.lit(":"), F.substring(text, 11, 2), F.lit(":"), F.substring(text, 13, 2)))
    shaped = F.when(text.rlike(r"^\d+$"), compact).when(text.rlike(_ISO), text)
    return shaped.try_cast("timestamp_ntz")


def parse_timestamp_strict(raw: Column) -> Column:
    """The same; a non-blank text that can't be parsed fails the query."""
    parsed = parse_timestamp(raw)
    bad = raw.isNotNull() & (F.trim(raw) != "") & parsed.isNull()
    return F.when(bad, F.raise_error(F.concat(F.lit("not a date: "), raw)).cast("timestamp_ntz")).otherwise(parsed)


def precision(raw: Column, null_is_timestamp: bool = True) -> Column:
    """``date_only`` for text without a time of day; null text as the SQL form (timestamp) or as null."""
    kind = F.when(F.trim(raw).rlike(r"^(\d{8}|\d{4}-\d{2}-\d{2})$"), DATE_ONLY).otherwise(TIMESTAMP)
    return kind if null_is_timestamp else F.when(raw.isNotNull(), kind)


def day(ts: Column) -> Column:
    return F.date_trunc("day", ts).cast("timestamp_ntz")


def days_from(ts: Column, days: int) -> Column:
    return ts + F.expr(f"INTERVAL '{days}' DAY")


def in_look_back(event: Column, kind: Column, index: Column, days: int) -> Column:
    """Event at or before the index and at most ``days`` before it; a date-only event counts by its day."""
    exact = (event <= index) & (event >= days_from(index, -days))
    by_day = (day(event) <= day(index)) & (day(event) >= days_from(day(index), -days))
    return F.when(kind == DATE_ONLY, by_day).otherwise(exact)


def in_follow_up(event: Column, kind: Column, index: Column, first: int, last: int) -> Column:
    """Event in ``[index + first days, index + last days]``, date-only events by day."""
    exact = (event >= days_from(index, first)) & (event <= days_from(index, last))
    by_day = (day(event) >= days_from(day(index), first)) & (day(event) <= days_from(day(index), last))
    return F.when(kind == DATE_ONLY, by_day).otherwise(exact)


def inclusive_end(ts: Column, kind: Column) -> Column:
    """The last moment a bound includes: the day's last microsecond when it has no time of day."""
    return F.when(kind == DATE_ONLY, day(ts) + F.expr("INTERVAL '1' DAY") - F.expr("INTERVAL '0.000001' SECOND")).otherwise(ts)


def separated(first: Column, first_kind: Column, second: Column, second_kind: Column, days: int) -> Column:
    """At least ``days`` between two events; whole days when either has no time of day."""
    by_day = day(second) >= days_from(day(first), days)
    exact = second >= days_from(first, days)
    return F.when((first_kind == DATE_ONLY) | (second_kind == DATE_ONLY), by_day).otherwise(exact)


def boundaries(unit: str, start: Column, end: Column) -> Column:
    """How many ``unit`` boundaries lie between two moments (not whole units elapsed)."""
    a, b = F.date_trunc(unit, start), F.date_trunc(unit, end)
    return F.timestamp_diff(unit.upper(), a, b).cast("bigint")


def whole_days(start: Column, end: Column) -> Column:
    """Floor of the elapsed days."""
    return F.floor(F.timestamp_diff("SECOND", start, end) / 86400).cast("bigint")


def iso_date(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def iso_second(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
