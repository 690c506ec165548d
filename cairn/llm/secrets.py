"""Secret scan with corpus-wide ownership frequency (operator 6); DataFrame and SQL functions only.

Candidates of four kinds are found in every whole text: ``assign`` (a keyword,
a sign and a value), ``access`` (key ids), ``hex`` (long hexadecimal runs) and
``vendor`` (tokens with well-known prefixes).  The hash of each candidate's
value is counted over the corpus by distinct repositories and owners.  A value
under several owners is a widely copied example; one that a single owner has
and that looks random is a live-looking credential, and its place is added as a
``live`` span beside the base ones.

Scale: texts are scanned where they lie and never shuffled; the work on a text is
linear in its matches.  Candidate rows (16-byte hashes) are reduced to distinct (hash, owner, repository) before they
are counted, so a value that a third of the rows repeat is one row per
repository, spread over tasks; its join partition can be split at run time.

Defined results: null or empty text has no spans; null keys and owners are
carried (a null owner is one owner); repeated rows are each returned, and count
once; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairn.llm import common

# The base kinds' patterns, in their listed order, and the least lengths.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 6
ACCESS = "AKIA[A-Z0-9]{16,}"  # AKIA[A-Z0-9]+ of 20+ characters: a run has one leftmost start, so the bound can be in the pattern
HEX = "[0-9a-f]{24,}"
VENDOR = "(?:ghp_|gho_|glpat-|xox[abp]-|sk_live_|sk-)[A-Za-z0-9_-]{16,}"
KINDS = ("assign", "access", "hex", "vendor", "live")

#: Owners from which on a value counts as widely copied.
COPIED_OWNERS = 2
_PLACEHOLDER = "(?i)example|sample|dummy|changeme|placeholder|your|xxxx"
_LEAST = (ASSIGN_VALUE, 0, 0, 0)


def _found(kind: int, pattern: str, value_group: int = 0) -> Column:
    """A kind's matches in order: each with the length of the text before it, its own, and its value's length and marks."""
    value, values = ("e.`2`", f", regexp_extract_all(text, r'{{0}}', {value_group})") if value_group else ("e.`1`", "")
    quoted = pattern.replace('"', r"\x22").replace("'", r"\x27")  # the same characters, for a raw SQL literal
    return F.expr(
        f"""CASE WHEN text RLIKE r'{quoted}' THEN transform(
          filter(arrays_zip(split(text, r'{quoted}', -1), regexp_extract_all(text, r'{quoted}', 0){values.replace("{0}", quoted)}), e -> e.`1` IS NOT NULL),
          e -> named_struct('gap', length(e.`0`), 'length', length(e.`1`), 'value', length({value}), 'hash', unhex(md5({value})),
            'random', length({value}) >= 16 AND {value} RLIKE '[0-9]' AND {value} RLIKE '[A-Za-z]' AND NOT {value} RLIKE '{_PLACEHOLDER}' AND size(array_distinct(split({value}, ''))) >= 8)) END"""
    )


def candidates(docs: DataFrame, *, key: str = "doc_id", text: str = "text", owner: str = "source", repo: str = "doc_id") -> DataFrame:
    """(row, doc_id, owner, repo, kinds): for each kind a document's matches, null where there are none."""
    base = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(owner).cast("string").alias("owner"), F.col(repo).cast("string").alias("repo"), common.text_or_empty(text).alias("text"))
    kinds = F.array(_found(0, "(?i)" + ASSIGN, 2), _found(1, ACCESS), _found(2, HEX), _found(3, VENDOR))
    return base.select("doc_id", "owner", "repo", kinds.alias("kinds")).select(F.monotonically_increasing_id().alias("row"), "doc_id", "owner", "repo", "kinds")


def spans(found: DataFrame) -> DataFrame:
    """(row, doc_id, owner, repo, kind, start, stop, vstart, hash, random): one row for each span long enough.

    Places are running sums of lengths in a row's kind, so their cost grows
    with the number of matches, however many a text has.
    """
    each = found.select("row", "doc_id", "owner", "repo", F.posexplode("kinds").alias("kind", "m")).select("row", "doc_id", "owner", "repo", "kind", F.posexplode("m").alias("place", "m"))
    stop = F.sum(F.col("m.gap") + F.col("m.length")).over(Window.partitionBy("row", "kind").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)).cast("int")
    least = F.element_at(F.array(*map(F.lit, _LEAST)), F.col("kind") + 1)
    placed = each.withColumn("stop", stop).filter(F.col("m.value") >= least)
    return placed.select("row", "doc_id", "owner", "repo", "kind", (F.col("stop") - F.col("m.length")).alias("start"), "stop", (F.col("stop") - F.col("m.value")).alias("vstart"), "m.hash", "m.random")


def ownership(each: DataFrame) -> DataFrame:
    """(hash, owners, repos): how many distinct owners and repositories hold each candidate value of ``spans``."""
    places = each.groupBy("hash", "owner", "repo").agg(F.lit(1).alias("one"))
    by_owner = places.groupBy("hash", "owner").agg(F.count("*").alias("repos"))
    return by_owner.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("repos").alias("repos"))


def _rendered(spans: str, kinds: str = "true") -> Column:
    names = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(f"array_join(transform(filter({spans}, s -> {kinds}), s -> concat(element_at(array({names}), s.kind + 1), ':', s.start, ':', s.stop)), ',')")


def scan(spark: SparkSession, docs: DataFrame, *, key: str = "doc_id", text: str = "text", owner: str = "source", repo: str = "doc_id", copied_owners: int = COPIED_OWNERS) -> DataFrame:
    """Per document: counts of the base kinds, digest of its base spans, all spans, and its live and copied candidates."""
    found = common.written(spark, candidates(docs, key=key, text=text, owner=owner, repo=repo), "candidates")
    each = common.written(spark, spans(found), "spans")
    counts = common.written(spark, ownership(each), "ownership")
    judged = each.join(counts, "hash", "left").select(
        "row", "kind", "start", "stop", "vstart",
        (F.col("owners") >= copied_owners).alias("copied"),
        (F.col("random") & (F.col("owners") < copied_owners)).alias("live"),
    )
    live = judged.filter("live").select("row", F.lit(len(KINDS) - 1).alias("kind"), F.col("vstart").alias("start"), "stop", F.lit(False).alias("copied")).distinct()
    every = judged.select("row", "kind", "start", "stop", "copied").unionByName(live)
    count = lambda kind: F.count_if(F.col("kind") == kind)
    lists = every.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "stop"))).alias("every"),
        count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), count(len(KINDS) - 1).alias("n_live"), F.count_if("copied").alias("n_copied"),
    )
    zero = lambda name: F.coalesce(name, F.lit(0)).cast("long").alias(name)
    every = F.coalesce("every", F.expr("cast(array() AS array<struct<start:int,kind:int,stop:int>>)")).alias("every")
    whole = found.select("row", "doc_id").join(lists, "row", "left").select("doc_id", every, *map(zero, ("n_assign", "n_access", "n_hex", "n_live", "n_copied")))
    return whole.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(_rendered("every", "s.kind < 3"), 256).alias("base_sha256"), _rendered("every").alias("spans"), "n_live", "n_copied")


def oracle(copied_owners: int = COPIED_OWNERS) -> str:
    """The same result as DuckDB SQL over the view ``documents``, written independently with list functions."""
    import re

    either = re.sub("[a-z]", lambda m: f"[{m[0]}{m[0].upper()}]", "(password|passwd|secret|token|api_?key)")
    assign = ASSIGN.replace("(password|passwd|secret|token|api_?key)", either).replace("'", "''")
    kinds = [("assign", assign, 2, ASSIGN_VALUE), ("access", "AKIA[A-Z0-9]+", 0, 20), ("hex", "[0-9a-f]+", 0, 24), ("vendor", VENDOR, 0, 0)]
    parts = []
    for number, (_, pattern, group, least) in enumerate(kinds):
        parts.append(f"""SELECT rid, doc_id, source, {number} AS kind, unnest(list_transform(range(1, len(m) + 1), lambda i: struct_pack(
            s := coalesce(list_sum(list_transform(p[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0),
            n := length(m[i]), v := v[i]))) AS u, {least} AS least
          FROM (SELECT rid, doc_id, source, regexp_extract_all(t, '{pattern}') AS m, regexp_extract_all(t, '{pattern}', {group}) AS v, regexp_split_to_array(t, '{pattern}') AS p FROM d)""")
    names = "['assign','access','hex','vendor','live']"
    return f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
      raw AS ({' UNION ALL '.join(parts)}),
      c AS (SELECT rid, doc_id, source, kind, CAST(u.s AS BIGINT) AS s, CAST(u.s + u.n AS BIGINT) AS e, CAST(u.s + u.n - length(u.v) AS BIGINT) AS vs, u.v AS v FROM raw WHERE length(u.v) >= least),
      o AS (SELECT v, count(DISTINCT source) + max(CASE WHEN source IS NULL THEN 1 ELSE 0 END) AS owners FROM c GROUP BY v),
      j AS (SELECT c.*, owners >= {copied_owners} AS copied, owners < {copied_owners} AND length(c.v) >= 16 AND regexp_matches(c.v, '[0-9]') AND regexp_matches(c.v, '[A-Za-z]')
              AND NOT regexp_matches(c.v, '{_PLACEHOLDER}') AND len(list_distinct(string_split(c.v, ''))) >= 8 AS live FROM c JOIN o USING (v)),
      every AS (SELECT rid, kind, s, e FROM j UNION ALL SELECT DISTINCT rid, 4, vs, e FROM j WHERE live),
      g AS (SELECT rid, count(*) FILTER (WHERE kind = 0) AS a, count(*) FILTER (WHERE kind = 1) AS b, count(*) FILTER (WHERE kind = 2) AS h, count(*) FILTER (WHERE kind = 4) AS l,
              string_agg({names}[kind + 1] || ':' || s || ':' || e, ',' ORDER BY s, kind, e) FILTER (WHERE kind < 3) AS base,
              string_agg({names}[kind + 1] || ':' || s || ':' || e, ',' ORDER BY s, kind, e) AS spans FROM every GROUP BY rid),
      k AS (SELECT rid, count(*) FILTER (WHERE copied) AS n FROM j GROUP BY rid)
      SELECT d.doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(h, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
        coalesce(spans, '') AS spans, coalesce(l, 0) AS n_live, coalesce(k.n, 0) AS n_copied
      FROM d LEFT JOIN g USING (rid) LEFT JOIN k USING (rid)"""
