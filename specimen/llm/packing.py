"""Packing (operator 5): harmonic packing of token ids into sequences.

A document's ids (public byte-level BPE, then id 0) are cut into full sequences
of ``capacity`` and a rest.  Lengths fall into reciprocal-capacity classes: class
j takes pieces of at most capacity // j, j to a bin.  A rest that would waste
more than ``WASTE`` of a bin filled with its like is cut once more, at exactly
the capacity of the next class, and what is left is classed again, so bins of
every class fill to within a few ids.  Each task fills the bins of each class
with its fixed number of pieces on its own, with no shuffle; at its end the few
pieces of unfilled bins (under j per class) go first-fit into shared bins, the
longest first.

Memory: one batch and one unfilled bin per class.
Sequence ids are (partition << 32) + n, so a task run again gives the same rows.

Defined results: null and empty texts are the single id 0; rows that repeat a
doc_id are packed each on its own; a null doc_id stays null; an empty table
gives no rows; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specimen.llm.common import documents
from specimen.llm.tokens import encoder

CAPACITY, END_ID, CLASSES, WASTE = 1024, 0, 128, 0.03
_ROWS_OUT, _BYTES_OUT = 20_000, 16 << 20


def cut_plan(rest: int, capacity: int = CAPACITY, classes: int = CLASSES,
             waste: float = WASTE) -> list[tuple[int, int]]:
    """(length, class) of the pieces of a rest shorter than a sequence."""
    out = []
    while rest:
        j = min(classes, capacity // rest)
        if (capacity // j - rest) * j <= waste * capacity or j == classes:
            out.append((rest, j))
            break
        cap = capacity // (j + 1)
        out.append((cap, capacity // cap))
        rest -= cap
    return out


class _Bins:
    """The unfilled bins of one task."""

    def __init__(self, capacity: int, part: int):
        self.capacity, self.next_id = capacity, part << 32
        self.open: dict[int, list] = {}
        self.plans = [cut_plan(r, capacity) for r in range(capacity)]

    def close(self, pieces: list):
        at, seq = 0, self.next_id
        self.next_id += 1
        for doc, start, ids, total in pieces:
            n = len(ids) // 4
            yield doc, start, n, ids, total, seq, at
            at += n

    def add(self, doc, ids: bytes):
        total, step = len(ids) // 4, self.capacity
        full = total // step
        for k in range(full):
            yield from self.close([(doc, k * step, ids[4 * k * step:4 * (k + 1) * step], total)])
        at = full * step
        for n, j in self.plans[total - at]:
            held = self.open.setdefault(j, [])
            held.append((doc, at, ids[4 * at:4 * (at + n)], total))
            at += n
            if len(held) == j:
                yield from self.close(self.open.pop(j))

    def rest(self):
        """First-fit, longest first, over the pieces of unfilled bins."""
        pieces = sorted((p for held in self.open.values() for p in held), key=lambda p: -len(p[2]))
        bins: list[list] = []
        room: list[int] = []
        for p in pieces:
            n = len(p[2]) // 4
            k = next((i for i, r in enumerate(room) if r >= n), None)
            if k is None:
                bins.append([])
                room.append(self.capacity)
                k = len(bins) - 1
            bins[k].append(p)
            room[k] -= n
        for held in bins:
            yield from self.close(held)


def pack(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID,
         json_path: str | None = None, ranks_path: str | None = None) -> DataFrame:
    """Pieces of all rows: (doc_id, start, length, ids, doc_tokens, sequence_id,
    offset); ``ids`` holds little-endian unsigned 32-bit ids."""
    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    tail = np.array([end_id], "<u4").tobytes()

    def run(batches):
        encode = encoder(json_path, ranks_path)
        bins = _Bins(capacity, TaskContext.get().partitionId())
        for b in batches:
            id_type, held, size = b.column(0).type, [], 0
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                for row in bins.add(doc, encode(text.as_py() or "") + tail):
                    held.append(row)
                    size += len(row[3])
                    if len(held) >= _ROWS_OUT or size >= _BYTES_OUT:
                        yield _rows(held, id_type)
                        held, size = [], 0
            if held:
                yield _rows(held, id_type)
        if held := list(bins.rest()):
            yield _rows(held, id_type)

    return rows.mapInArrow(run, f"doc_id {kind}, start long, length long, ids binary, "
                                "doc_tokens long, sequence_id long, offset long")


def _rows(held: list[tuple], id_type) -> pa.RecordBatch:
    doc, start, n, ids, total, seq, at = zip(*held)
    return pa.RecordBatch.from_arrays(
        [pa.array(doc, id_type), pa.array(start, pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.binary()),
         pa.array(total, pa.int64()), pa.array(seq, pa.int64()), pa.array(at, pa.int64())],
        names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(pack(documents(spark, sf_dir)))
