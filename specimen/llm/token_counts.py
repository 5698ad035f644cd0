"""Token counts (operator 3) that follow edits.

A text is cut before spaces that stand between two non-spaces, which is always
a pre-token boundary of the byte-level vocabulary.  ``LEAF`` such chunks make a
leaf; a document keeps the characters of its leaves and a segment tree of token
counts (an implicit binary heap, root at 1).  The tree is an ordinary array
column, so it can be stored and edited in a later run.

An edit replaces the code points [start, end) by a text.  The leaves it touches
are found, then widened leaf by leaf while either edge is no longer a safe cut
(boundary context); only that region is encoded again, its counts are spread
over the same leaves, and the sums on the paths to the root are updated.

Both steps are row-wise ``mapInArrow`` passes: nothing is shuffled, memory is one
batch plus a bounded cache of chunk ids.

Defined results: a null text is empty (0 tokens, one empty leaf); edits are in
positions of the unedited text, apply from the last to the first, are clipped to
the text, and later ones of overlapping edits are clipped to what is left of the
earlier ones; null edits are none; rows that repeat an id are counted each on
its own; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specimen.llm.common import documents
from specimen.llm.tokens import chunk_encoder

LEAF = 32
_CUT = re.compile(r"(?<=\S) (?=\S)")
EDITS = "array<struct<start:int,end:int,text:string>>"


def _chunks(text: str) -> list[str]:
    at = [0, *(m.start() for m in _CUT.finditer(text)), len(text)]
    return [text[a:b] for a, b in zip(at, at[1:])] if text else [""]


class Tree:
    """Leaf lengths and a heap of token sums over them."""

    def __init__(self, chars: list[int], heap: list[int]):
        self.chars, self.heap = np.array(chars, np.int64), np.array(heap, np.int64)

    @classmethod
    def build(cls, text: str, encode, leaf: int = LEAF) -> "Tree":
        chunks = _chunks(text)
        tokens = np.fromiter((len(encode(c)) // 4 for c in chunks), np.int64, len(chunks))
        chars = np.fromiter(map(len, chunks), np.int64, len(chunks))
        at = np.arange(0, len(chunks), leaf)
        leaves = np.add.reduceat(tokens, at)
        size = 1 << int(len(leaves) - 1).bit_length()
        heap = np.zeros(2 * size, np.int64)
        heap[size:size + len(leaves)] = leaves
        level = size
        while level > 1:  # each level is the pair sums of the one below
            heap[level // 2:level] = heap[level:2 * level].reshape(-1, 2).sum(axis=1)
            level //= 2
        return cls(np.add.reduceat(chars, at), heap)

    @property
    def total(self) -> int:
        return int(self.heap[1])

    def _set(self, leaf: int, tokens: int) -> None:
        i = len(self.heap) // 2 + leaf
        self.heap[i] = tokens
        while i > 1:
            i //= 2
            self.heap[i] = self.heap[2 * i] + self.heap[2 * i + 1]

    def edit(self, text: str, start: int, end: int, new: str, encode) -> tuple[str, int]:
        """Apply one edit; returns the new text and the characters encoded."""
        ends = np.cumsum(self.chars)
        a = int(min(np.searchsorted(ends, start, "right"), len(ends) - 1))
        b = int(min(np.searchsorted(ends, max(end - 1, start), "right"), len(ends) - 1))
        out = text[:start] + new + text[end:]
        grown = len(out) - len(text)
        safe = lambda p: bool(_CUT.match(out, p))
        while a > 0 and not safe(int(ends[a] - self.chars[a])):
            a -= 1
        while b < len(ends) - 1 and not safe(int(ends[b]) + grown):
            b += 1
        lo, hi = int(ends[a] - self.chars[a]), int(ends[b]) + grown
        chunks = _chunks(out[lo:hi])
        per = -(-len(chunks) // (b - a + 1))
        for k, leaf in enumerate(range(a, b + 1)):
            part = chunks[k * per:(k + 1) * per]
            self.chars[leaf] = sum(map(len, part))
            self._set(leaf, sum(len(encode(c)) // 4 for c in part))
        return out, hi - lo


def clipped(edits, n: int) -> list[tuple[int, int, str]]:
    """Edits within [0, n], not overlapping, from the last to the first."""
    out, free = [], 0
    for e in sorted((e for e in edits or [] if e), key=lambda e: (e["start"] or 0, e["end"] or 0)):
        start = min(max(e["start"] or 0, free), n)
        end = min(max(e["end"] or 0, start), n)
        out.append((start, end, e["text"] or ""))
        free = end
    return out[::-1]


def count_tokens(docs: DataFrame, keep: tuple[str, ...] = (), leaf: int = LEAF,
                 json_path: str | None = None, ranks_path: str | None = None) -> DataFrame:
    """(doc_id, text, n_tokens, leaf_chars, tree, *keep) of every row."""
    rows = docs.select("doc_id", "text", *keep)

    def run(batches):
        encode = chunk_encoder(json_path, ranks_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                b = batch.slice(at, 256)
                trees = [Tree.build(t or "", encode, leaf) for t in b.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array([t.total for t in trees], pa.int64()),
                     pa.array([t.chars for t in trees], pa.list_(pa.int32())),
                     pa.array([t.heap for t in trees], pa.list_(pa.int32())),
                     *b.columns[2:]], names=["doc_id", "text", "n_tokens", "leaf_chars", "tree", *keep])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    more = "".join(f", {c} {kinds[c]}" for c in keep)
    return rows.mapInArrow(run, f"doc_id {kinds['doc_id']}, text string, n_tokens long, "
                                f"leaf_chars array<int>, tree array<int>{more}")


def apply_edits(counted: DataFrame, json_path: str | None = None, ranks_path: str | None = None) -> DataFrame:
    """``counted`` (with a column ``edits``) after its edits: (doc_id, text,
    n_before, n_tokens, n_encoded, leaf_chars, tree); ``n_encoded`` counts the
    characters that were encoded again."""
    rows = counted.select("doc_id", "text", "n_tokens", "leaf_chars", "tree", "edits")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        encode = chunk_encoder(json_path, ranks_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                b = batch.slice(at, 256)
                texts, trees, work = [], [], []
                for text, chars, heap, edits in zip(*(b.column(i).to_pylist() for i in (1, 3, 4, 5))):
                    tree, done, text = Tree(chars, heap), 0, text or ""
                    for start, end, new in clipped(edits, len(text)):
                        text, n = tree.edit(text, start, end, new, encode)
                        done += n
                    texts.append(text)
                    trees.append(tree)
                    work.append(done)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(texts, pa.string()), b.column(2),
                     pa.array([t.total for t in trees], pa.int64()), pa.array(work, pa.int64()),
                     pa.array([t.chars for t in trees], pa.list_(pa.int32())),
                     pa.array([t.heap for t in trees], pa.list_(pa.int32()))],
                    names=["doc_id", "text", "n_before", "n_tokens", "n_encoded", "leaf_chars", "tree"])

    return rows.mapInArrow(run, f"doc_id {kind}, text string, n_before long, n_tokens long, n_encoded long, "
                                "leaf_chars array<int>, tree array<int>")


def sample_edits(text) -> F.Column:
    """Three edits a text: an insertion, a deletion and a replacement at its
    quarters, each crossing word or white-space boundaries in many texts."""
    n = F.length(F.coalesce(text, F.lit("")))
    one = lambda at, size, new: F.struct(
        at.cast("int").alias("start"), (at + size).cast("int").alias("end"), F.lit(new).alias("text"))
    return F.array(one(F.floor(n / 4), 0, " inserted words, 42"), one(F.floor(n / 2), 10, ""),
                   one(F.floor(3 * n / 4), 5, "Ünï  \n<b>"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    counted = count_tokens(docs).withColumn("edits", sample_edits(F.col("text")))
    out = apply_edits(counted)
    return out.select("doc_id", F.col("n_before").alias("n_tokens"), F.col("n_tokens").alias("n_edited_tokens"),
                      F.length("text").cast("long").alias("n_edited_chars"), "n_encoded")
