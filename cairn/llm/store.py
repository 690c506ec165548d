"""Content-addressed store of token ids (operator 4).

A rolling hash over the last 16 ids cuts each document's id stream into
chunks; a chunk's key is the BLAKE2b-128 of its bytes, and each chunk is stored
once.  A document is a recipe: its chunk keys in order, its token counts and
its Merkle root.  Recipes lie in ascending doc_id order with running starts;
every recipe file has a manifest row (its document count, tokens and the Merkle
root of its documents), and a top manifest row has the root of all files.

Layout (Parquet): ``stage/kind=chunk/`` (key, width, payload: little-endian ids
of ``width`` bytes), ``recipes/`` (doc_id, part, row, start, n_tokens, keys, root),
``manifest/`` (part, first_doc_id, docs, tokens, root; part -1 is the top).  The
recipes come out of the same pass as the chunks, as ``stage/kind=recipe/``, which
goes when they lie in order.

Scale: texts are encoded once; the payload crosses one shuffle, by chunk key,
after each task has dropped its own repeats, so a chunk that a third of the
corpus shares arrives at most once from each task.  Reading back verifies each
stored chunk where it lies, and only 28-byte (key, count, crc) rows meet the
recipes; a document's crc is combined from its chunks' crcs.

Defined results: null or empty text is the end id alone; null and repeated
doc_ids are kept (nulls first; repeats in the order of their content); an empty
table gives an empty store; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm import common, tokens

END_ID = 2
WINDOW = 16
#: A cut where these bits of the rolling hash are zero: every 1,024 ids on average.
CUT_BITS = 10
MIN_CHUNK, MAX_CHUNK = 192, 8192
KEY_BYTES = 16
_MULT = np.uint64(0x9E3779B97F4A7C15)
_ZEROS = bytes(4 * MAX_CHUNK)


def _rolling(ids: np.ndarray) -> np.ndarray:
    """Polynomial hash of the last WINDOW ids at each place, by doubling."""
    h = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    step, power = 1, _MULT
    with np.errstate(over="ignore"):
        while step < WINDOW:
            more = h.copy()
            more[step:] += h[:-step] * power
            h, power, step = more, power * power, step * 2
    return h


def cut_points(ids: np.ndarray) -> list[int]:
    """Chunk ends, the last one the stream's length; a function of the content alone."""
    n = len(ids)
    wanted = np.flatnonzero((_rolling(ids) >> np.uint64(64 - CUT_BITS)) == 0) + 1
    ends, last = [], 0
    for cut in wanted.tolist():
        while cut - last > MAX_CHUNK:
            last += MAX_CHUNK
            ends.append(last)
        if cut - last >= MIN_CHUNK:
            ends.append(cut)
            last = cut
    while n - last > MAX_CHUNK:
        last += MAX_CHUNK
        ends.append(last)
    if last < n:
        ends.append(n)
    return ends


def _key(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=KEY_BYTES).digest()


def merkle(keys: list[bytes]) -> bytes:
    """Root of a binary Merkle tree; an odd last node goes up as it is."""
    level = list(keys) or [b""]
    while len(level) > 1:
        level = [_key(b"\x01" + b"".join(level[i : i + 2])) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return _key(b"\x00" + level[0])


def encode_chunks(docs: DataFrame, *, key: str, text: str, end_id: int, tokenizer: str) -> DataFrame:
    """Chunk rows (key, width, payload; a task's repeats dropped) and recipe rows, told apart by ``kind``."""
    schema = "kind string, spread long, key binary, width int, payload binary, doc_id long, n_tokens long, root binary"
    names = [x.split()[0] for x in schema.split(", ")]
    types = [pa.string(), pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokens.encoder(tokenizer)
        seen: set[bytes] = set()
        for batch in common.sliced(batches, 1):
            rows: list[tuple] = []
            for doc, ids in zip(batch.column(0).to_pylist(), enc.encode_many(batch.column(1).to_pylist())):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                width = 2 if int(ids.max()) < 65536 else 4
                data, at, keys = ids.astype(f"<u{width}").tobytes(), 0, []
                for end in cut_points(ids):
                    payload = data[at * width : end * width]
                    keys.append(k := _key(bytes([width]) + payload))
                    at = end
                    if k not in seen:
                        seen.add(k)
                        rows.append(("chunk", int.from_bytes(k[:8], "little", signed=True), k, width, payload, None, None, None))
                root = merkle(keys)
                rows.append(("recipe", int.from_bytes(root[:8], "little", signed=True) ^ (doc or 0), b"".join(keys), None, None, doc, len(ids), root))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows) if rows else [()] * 8, types)], names)

    return docs.select(F.col(key).cast("long").alias("doc_id"), common.text_or_empty(text).alias("text")).mapInArrow(run, schema)


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Drop repeats of a chunk key within the partition; recipes pass."""
    import pyarrow.compute as pc

    seen: set[bytes] = set()
    for batch in batches:
        keep = []
        for kind, k in zip(batch.column("kind").to_pylist(), batch.column("key").to_pylist()):
            keep.append(kind == "recipe" or k not in seen)
            if kind == "chunk":
                seen.add(k)
        yield batch.filter(pa.array(keep, pa.bool_())) if not all(keep) else batch


def write_store(spark: SparkSession, docs: DataFrame, path: str, *, key: str = "doc_id", text: str = "text", end_id: int = END_ID, tokenizer: str | None = None) -> str:
    """Encode ``docs`` and write the store at ``path``; returns ``path``."""
    common.prepare(spark)
    rows = encode_chunks(docs, key=key, text=text, end_id=end_id, tokenizer=tokenizer or tokens.vocab_path())
    dealt = rows.repartition("spread")
    dealt.mapInArrow(_once, rows.schema).write.partitionBy("kind").option("compression", "zstd").parquet(f"{path}/stage")

    stage = spark.read.schema(rows.schema).parquet(f"{path}/stage")
    recipes = stage.filter("kind = 'recipe'").select("doc_id", "n_tokens", F.col("key").alias("keys"), "root")

    def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row, start = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            n = batch.column("n_tokens").to_numpy()
            ends = start + np.cumsum(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.full(len(n), part, dtype=np.int32)), pa.array(np.arange(row, row + len(n), dtype=np.int64)), pa.array(ends - n), batch.column("n_tokens"), batch.column("keys"), batch.column("root")],
                ["doc_id", "part", "row", "start", "n_tokens", "keys", "root"],
            )
            row, start = row + len(n), int(ends[-1]) if len(n) else start

    ordered = recipes.repartitionByRange("doc_id", "n_tokens", "root").sortWithinPartitions("doc_id", "n_tokens", "root")
    ordered.mapInArrow(running, "doc_id long, part int, row long, start long, n_tokens long, keys binary, root binary").write.option("compression", "zstd").parquet(f"{path}/recipes")
    common.drop_path(spark, f"{path}/stage/kind=recipe")

    def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows of a part arrive in row order (sorted below); one part's roots are held at a time
        part, docs_n, total, first, held = None, 0, 0, None, []

        def out():
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([first], pa.int64()), pa.array([docs_n], pa.int64()), pa.array([total], pa.int64()), pa.array([merkle(held)], pa.binary())], ["part", "first_doc_id", "docs", "tokens", "root"])

        for batch in batches:
            for p, doc, n, root in zip(*(batch.column(c).to_pylist() for c in ("part", "doc_id", "n_tokens", "root"))):
                if p != part:
                    if part is not None:
                        yield out()
                    part, docs_n, total, first, held = p, 0, 0, doc, []
                docs_n, total = docs_n + 1, total + n
                held.append(root)
        if part is not None:
            yield out()

    back = spark.read.parquet(f"{path}/recipes").select("part", "row", "doc_id", "n_tokens", "root")
    parts = back.repartition("part").sortWithinPartitions("part", "row").mapInArrow(roots, "part int, first_doc_id long, docs long, tokens long, root binary")
    found = sorted(parts.collect(), key=lambda r: r["part"])  # one row per recipe file
    top = (-1, None, sum(r["docs"] for r in found), sum(r["tokens"] for r in found), merkle([bytes(r["root"]) for r in found]))
    spark.createDataFrame([top, *map(tuple, found)], "part int, first_doc_id long, docs long, tokens long, root binary").coalesce(1).write.parquet(f"{path}/manifest")
    return path


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("key binary, width int, payload binary, kind string").parquet(f"{path}/stage").filter("kind = 'chunk'").select("key", "width", "payload")


def _recipes(spark: SparkSession, path: str) -> DataFrame:
    """Recipes with starts over the whole store: a file's own running starts plus the tokens of the files before it."""
    base, total = [], 0
    for r in spark.read.parquet(f"{path}/manifest").filter("part >= 0").orderBy("part").collect():
        base.append((r["part"], total))
        total += r["tokens"]
    bases = spark.createDataFrame(base, "part int, base long")  # a row per recipe file
    recipes = spark.read.schema("doc_id long, part int, row long, start long, n_tokens long, keys binary, root binary").parquet(f"{path}/recipes")
    return recipes.join(F.broadcast(bases), "part").withColumn("start", F.col("start") + F.col("base")).drop("base")


def _links(recipes: DataFrame) -> DataFrame:
    places = F.explode(F.sequence(F.lit(0), (F.length("keys") / KEY_BYTES).cast("int") - 1))
    return recipes.select("part", "row", "keys", places.alias("at")).select("part", "row", "at", F.expr(f"substring(keys, at * {KEY_BYTES} + 1, {KEY_BYTES})").alias("key"))


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32, and ``verified``.

    ``verified``: every chunk's bytes match its key, counts add up and the Merkle root is the recipe's.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, n, crc, good = batch.column(0).to_pylist(), [], [], []
            for k, width, payload in zip(keys, batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                ids = np.frombuffer(payload, dtype=f"<u{width}").astype("<u4")
                n.append(len(ids))
                crc.append(zlib.crc32(ids.tobytes()))
                good.append(_key(bytes([width]) + payload) == k)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int32()), pa.array(crc, pa.int64()), pa.array(good, pa.bool_())], ["key", "n", "crc", "good"])

    stored = _chunks(spark, path).mapInArrow(digest, "key binary, n int, crc long, good boolean")
    recipes = _recipes(spark, path)
    joined = _links(recipes).join(stored, "key", "left")
    per_doc = joined.groupBy("part", "row").agg(F.sort_array(F.collect_list(F.struct("at", "n", "crc", "good", "key"))).alias("parts"))

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crcs, good = [], []
            for parts, n_tokens, root in zip(*(batch.column(c).to_pylist() for c in ("parts", "n_tokens", "root"))):
                crc, total, fine = 0, 0, True
                for p in parts:
                    if p["n"] is None:
                        fine = False
                        continue
                    total, fine = total + p["n"], fine and p["good"]
                    crc = zlib.crc32(_ZEROS[: 4 * p["n"]], crc ^ 0xFFFFFFFF) ^ 0xFFFFFFFF ^ p["crc"]  # crc of the two together
                crcs.append(crc)
                good.append(fine and total == n_tokens and merkle([p["key"] for p in parts]) == root)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(crcs, pa.int64()), pa.array(good, pa.bool_())], ["doc_id", "start", "n_tokens", "ids_crc32", "verified"])

    ready = recipes.drop("keys").join(per_doc, ["part", "row"]).select("doc_id", "start", "n_tokens", "root", "parts")
    return ready.mapInArrow(combine, "doc_id long, start long, n_tokens long, ids_crc32 long, verified boolean")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """The documents' ids themselves, rebuilt from the store: (doc_id, start, n_tokens, ids)."""
    recipes = _recipes(spark, path)
    joined = _links(recipes).join(_chunks(spark, path), "key")
    per_doc = joined.groupBy("part", "row").agg(F.sort_array(F.collect_list(F.struct("at", "width", "payload"))).alias("parts"))

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.concatenate([np.frombuffer(p["payload"], dtype=f"<u{p['width']}").astype(np.int64) for p in parts]) for parts in batch.column("parts").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(ids, pa.list_(pa.int64()))], ["doc_id", "start", "n_tokens", "ids"])

    return recipes.drop("keys", "root").join(per_doc, ["part", "row"]).select("doc_id", "start", "n_tokens", "parts").mapInArrow(rebuild, "doc_id long, start long, n_tokens long, ids array<long>")
