"""Fill-in-the-middle transformation (operator 11); DataFrame and SQL functions only.

A text's units are found by one pattern (white space with the word after it, or
white space at the end), so that joining them gives the text back.  Four
unsigned numbers from the SHA-256 of ``seed:key`` choose two cuts between units,
whether the text is rearranged at all, and in which form: ``psm`` (prefix,
suffix, middle) or ``spm`` (suffix, prefix, middle), each part behind its
sentinel.  A text that is empty or holds a sentinel stays plain.  Sentinels
begin with ``<``, end with ``>`` and hold neither elsewhere, so no part's end
and start can form another one, and splitting at them restores the text.

Scale: a narrow projection without any shuffle; a text is decided by its key
alone, so lost tasks and reruns give the same result.

Defined results: a null text is empty; a null key counts as an empty decimal
string; rows of one key are cut by the same numbers, each on its own text;
repeated rows are all returned; an empty table gives an empty result; columns
that clash with the new ones are replaced, all others are carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.llm import common

# The units' pattern and the sentinels of prefix, suffix and middle.
UNITS = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SENTINEL = "<[PSM]>"
SEED = 42
#: Of 100 texts, how many are rearranged, and how many of those have the suffix first.
RATE, SPM_RATE = 50, 80


def _number(digest: str, group: int) -> Column:
    return F.conv(F.substring(digest, 1 + 8 * group, 8), 16, 10).cast("long")


def transform(docs: DataFrame, *, key: str = "doc_id", text: str = "text", seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """``docs`` with ``n`` (units), ``form``, ``prefix_chars``, ``middle_chars`` (null if plain) and ``output``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("long").cast("string"), F.lit(""))), 256)
    body = common.text_or_empty(text)
    plain = (F.col("_body") == "") | F.col("_body").rlike(SENTINEL) | (_number("_digest", 2) % 100 >= rate)
    units = docs.select(*[F.col(c).alias(c) for c in docs.columns if c not in _MADE], body.alias("_body"), digest.alias("_digest"))
    units = units.withColumn("_units", F.expr(f"regexp_extract_all(_body, r'{UNITS}', 0)")).withColumn("n", F.size("_units").cast("long"))
    a, b = _number("_digest", 0) % (F.col("n") + 1), _number("_digest", 1) % (F.col("n") + 1)
    form = F.when(plain, "plain").when(_number("_digest", 3) % 100 < spm_rate, "spm").otherwise("psm")
    cut = units.select("*", form.alias("form"), F.least(a, b).cast("int").alias("_a"), F.greatest(a, b).cast("int").alias("_b"))
    part = lambda start, length: F.when(F.col("form") != "plain", F.array_join(F.slice("_units", start, length), ""))
    parts = cut.select(
        "*",
        part(F.lit(1), F.col("_a")).alias("_prefix"),
        part(F.col("_a") + 1, F.col("_b") - F.col("_a")).alias("_middle"),
        part(F.col("_b") + 1, F.col("n").cast("int") - F.col("_b")).alias("_suffix"),
    ).drop("_units")
    output = (
        F.when(F.col("form") == "psm", F.concat(F.lit(PREFIX), "_prefix", F.lit(SUFFIX), "_suffix", F.lit(MIDDLE), "_middle"))
        .when(F.col("form") == "spm", F.concat(F.lit(SUFFIX), "_suffix", F.lit(PREFIX), "_prefix", F.lit(MIDDLE), "_middle"))
        .otherwise(F.col("_body"))
    )
    kept = [c for c in docs.columns if c not in _MADE]
    return parts.select(*kept, "n", "form", F.char_length("_prefix").cast("long").alias("prefix_chars"), F.char_length("_middle").cast("long").alias("middle_chars"), output.alias("output"))


_MADE = ("n", "form", "prefix_chars", "middle_chars", "output")


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of: its parts between the sentinels, in their first order."""
    part = lambda i: F.get(F.split(output, SENTINEL, -1), F.lit(i))
    return F.when(form == "psm", F.concat(part(1), part(3), part(2))).when(form == "spm", F.concat(part(2), part(3), part(1))).otherwise(output)


def digests(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row what was done, with SHA-256 digests of the output and of the text restored from it."""
    made = transform(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")))
    back = made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", restored(F.col("output"), F.col("form")).alias("_back"))
    return back.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("_back", 256).alias("restored_sha256"))


def oracle() -> str:
    """The same result as DuckDB SQL over the view ``documents``; it restores with positions of the sentinels."""
    number = lambda g: f"CAST('0x' || substr(h, {1 + 8 * g}, 8) AS BIGINT)"
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
      u AS (SELECT *, regexp_extract_all(t, '{UNITS}') AS units FROM d),
      c AS (SELECT *, len(units) AS n, {number(0)} % (len(units) + 1) AS c1, {number(1)} % (len(units) + 1) AS c2,
          CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR {number(2)} % 100 >= {RATE} THEN 'plain'
               WHEN {number(3)} % 100 < {SPM_RATE} THEN 'spm' ELSE 'psm' END AS form FROM u),
      p AS (SELECT *, coalesce(array_to_string(units[1:least(c1, c2)], ''), '') AS pre, coalesce(array_to_string(units[least(c1, c2) + 1:greatest(c1, c2)], ''), '') AS mid,
          coalesce(array_to_string(units[greatest(c1, c2) + 1:n], ''), '') AS suf FROM c),
      o AS (SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS pc, CASE WHEN form <> 'plain' THEN length(mid) END AS mc,
          CASE form WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid ELSE t END AS o FROM p),
      r AS (SELECT *, strpos(o, '<P>') AS ip, strpos(o, '<S>') AS isf, strpos(o, '<M>') AS im FROM o)
      SELECT doc_id, CAST(n AS BIGINT) AS n, form, CAST(pc AS BIGINT) AS prefix_chars, CAST(mc AS BIGINT) AS middle_chars, sha256(o) AS output_sha256,
        sha256(CASE form WHEN 'psm' THEN substr(o, 4, isf - 4) || substr(o, im + 3) || substr(o, isf + 3, im - isf - 3)
                         WHEN 'spm' THEN substr(o, ip + 3, im - ip - 3) || substr(o, im + 3) || substr(o, 4, ip - 4) ELSE o END) AS restored_sha256 FROM r"""
