"""Column builders for codes, numbers, units, records and statuses (H-str*, H-num*, H-json, H-hash, J1, J7)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# Texts that the normalised tables read as missing.
NA_TOKENS = ("", " ", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

# Unit factors.
KPA_TO_MMHG = 7.5006168270417
KPA_TO_MMHG_SHORT = 7.50062
LB_TO_KG = 0.45359237
INCH_TO_M = 0.0254
LACTATE_DIVISOR = 9.008
FAHRENHEIT_FROM = 43.3


def norm_code(c: Column) -> Column:
    return F.upper(F.trim(c))


def norm_text(c: Column) -> Column:
    return F.lower(F.trim(F.coalesce(c, F.lit(""))))


def system_key(c: Column) -> Column:
    """A code system's name with nothing but capitals and digits."""
    return F.regexp_replace(F.upper(F.trim(c)), "[^A-Z0-9]", "")


def na_to_null(c: Column, tokens: Sequence[str] = NA_TOKENS) -> Column:
    """Exact missing-value texts become null; nothing is trimmed."""
    return F.when(c.isin(*tokens), F.lit(None)).otherwise(c)


def full_match(c: Column, pattern: str) -> Column:
    return c.rlike(f"^(?:{pattern})$")


def number(c: Column) -> Column:
    """Fail-soft double; texts that aren't plain numbers are null."""
    text = F.trim(c.cast("string"))
    return F.when(text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), text.try_cast("double"))


def finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))


def to_celsius(v: Column) -> Column:
    return F.when(v > FAHRENHEIT_FROM, (v - 32) * 5 / 9).otherwise(v)


def to_fahrenheit(v: Column) -> Column:
    return F.when(v < FAHRENHEIT_FROM, v * 9 / 5 + 32).otherwise(v)


def fib4(age: Column, ast: Column, alt: Column, platelets: Column) -> Column:
    return F.when((platelets > 0) & (alt > 0), age * ast / (platelets * F.sqrt(alt)))


def bmi(weight_kg: Column, height_m: Column) -> Column:
    return F.try_divide(weight_kg, F.pow(height_m, 2))


def recode(c: Column, mapping: Mapping[str, str]) -> Column:
    """Dictionary lookup; values outside the dictionary pass through."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.coalesce(F.create_map(*pairs)[c], c) if pairs else c


def divided_by_code(value: Column, code: Column, divisors: Mapping[str, float]) -> Column:
    """Values divided by what their code asks for (the mg/dL form of a result in mmol/L, say); others as they are."""
    out = value
    for name, divisor in divisors.items():
        out = F.when(norm_code(code) == name.strip().upper(), value / divisor).otherwise(out)
    return out


def death_month(raw: Column) -> Column:
    """``YYYYMM`` as ``YYYY-MM``; null and 0 as the empty text."""
    text = F.trim(raw.cast("string"))
    return F.when(text.isNull() | (text == "0") | (text == ""), "").otherwise(F.concat(F.substring(text, 1, 4), F.lit("-"), F.substring(text, 5, 2)))


def record_id(*columns: Column) -> Column:
    """SHA-256 over the columns, nulls skipped, unit-separator delimited."""
    return F.sha2(F.concat_ws("\x1f", *columns), 256)


def bucket(c: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(n)).cast("int")


def json_object(**fields: Column) -> Column:
    """JSON text that keeps null members."""
    return F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]), {"ignoreNullFields": "false"})


def status(flag: Column) -> Column:
    """met for true, else indeterminate: absence of evidence is never 'not met'."""
    return F.when(flag, "met").otherwise("indeterminate")


def any_true(*flags: Column) -> Column:
    """True if any is; null otherwise (members are true or null)."""
    return F.coalesce(*[F.when(f, F.lit(True)) for f in flags])


def count_true(*flags: Column) -> Column:
    return sum((F.coalesce(f, F.lit(False)).cast("int") for f in flags), F.lit(0)).cast("bigint")


@F.pandas_udf(DoubleType())
def half_visible(v: pd.Series) -> pd.Series:
    """The value after a round trip through half precision and its shortest printed form."""
    import numpy as np

    with np.errstate(over="ignore"):
        half = v.to_numpy(dtype="float64", na_value=float("nan")).astype("float16")
    return pd.Series([float("nan") if x != x else float(str(x)) for x in half])


def half_visible_or_null(c: Column) -> Column:
    return F.nanvl(half_visible(c), F.lit(None).cast("double"))
