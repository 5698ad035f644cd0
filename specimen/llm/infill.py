"""Fill-in-middle transformation (operator 11): in-place block rotations.

A text is cut into units (white space and the word after it; white space at the
end is a unit of its own).  Two cuts, drawn from a hash of the document's id,
give prefix, middle and suffix.  The text's bytes are held in one bytearray: the
cuts are found by one scan over its bytes, the three sentinels are inserted
there, and neighbouring blocks change places by rotations of three reversals
each (``rotate``): ``<P>prefix | <M>middle<S>suffix`` becomes the form ``psm``,
one more rotation of its first two blocks the form ``spm``.  ``restore`` finds
the sentinels, applies the rotations in the opposite order and takes the
sentinels out, so every output gives back exactly its text.

A text that holds a sentinel itself stays plain; sentinels share no character
but their brackets, so none can arise where blocks meet, and the first match is
always the inserted one.

Row-wise ``mapInArrow`` without an exchange: a task run again gives the same
rows.  Memory: one text, its copy in the bytearray, and output rows up to
``_BYTES_OUT``; reversals swap pieces of ``_SWAP`` bytes.

Defined results: a null text is the empty text; empty texts are plain with no
units, white space alone is one unit; a null doc_id is hashed as the empty id
and stays null; rows that repeat a doc_id are cut by the same draws, each on its
own text; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specimen.llm.common import documents

SEED, TURNED_PERCENT, SPM_PERCENT = "42", 50, 80
P, S, M = b"<P>", b"<S>", b"<M>"
_SWAP, _ROWS_OUT, _BYTES_OUT = 1 << 16, 10_000, 16 << 20


def reverse(buf: bytearray, a: int, b: int) -> None:
    """Reverse ``buf[a:b]`` in place, exchanging pieces from both ends."""
    while b - a > 1:
        n = min(_SWAP, (b - a) // 2)
        left, right = buf[a:a + n], buf[b - n:b]
        left.reverse()
        right.reverse()
        buf[a:a + n], buf[b - n:b] = right, left
        a, b = a + n, b - n


def rotate(buf: bytearray, a: int, b: int, c: int) -> None:
    """Exchange the neighbouring blocks ``buf[a:b]`` and ``buf[b:c]`` in place."""
    reverse(buf, a, b)
    reverse(buf, b, c)
    reverse(buf, a, c)


def unit_ends(data: bytes) -> np.ndarray:
    """The byte position after every unit of a text."""
    at = np.frombuffer(data, np.uint8)
    space = (at - np.uint8(9) < 5) | (at == 32)
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    return np.append(ends, len(at)) if len(at) else ends


def code_points(data: bytes, a: int, b: int) -> int:
    return int(np.count_nonzero(np.frombuffer(data, np.uint8)[a:b] & 0xC0 != 0x80))


def arrange(data: bytes, low: int, high: int, form: str) -> bytearray:
    """The text cut at bytes ``low`` and ``high``, with sentinels, as ``form``."""
    buf = bytearray(data)
    buf[high:high] = S
    buf[low:low] = M
    buf[:0] = P
    head, middle = len(P) + low, len(M) + high - low
    rotate(buf, head, head + middle, len(buf))
    if form == "spm":
        rotate(buf, 0, head, len(buf) - middle)
    return buf


def recover(output: bytes, form: str) -> bytes:
    """The text of an output of ``arrange``."""
    if form == "plain":
        return output
    buf = bytearray(output)
    middle = buf.find(M)
    if form == "spm":
        rotate(buf, 0, buf.find(P), middle)
    head = buf.find(S)
    rotate(buf, head, middle, len(buf))
    tail = head + len(buf) - middle
    del buf[tail:tail + len(S)], buf[head:head + len(M)], buf[:len(P)]
    return bytes(buf)


def draws(doc_id: str, seed: str = SEED) -> list[int]:
    """Four unsigned 32-bit integers of a document."""
    h = hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()
    return [int(h[i:i + 8], 16) for i in (0, 8, 16, 24)]


def _bytes(column: pa.Array) -> Iterator[bytes]:
    for v in column.cast(pa.binary()):
        yield v.as_py() or b""


def _strings(values: list[bytes]) -> pa.Array:
    """Bytes that are UTF-8 already as a string array, unread."""
    a = pa.array(values, pa.binary())
    return pa.Array.from_buffers(pa.string(), len(a), a.buffers())


def infill(docs: DataFrame, seed: str = SEED, turned_percent: int = TURNED_PERCENT,
           spm_percent: int = SPM_PERCENT) -> DataFrame:
    """(doc_id, output, form, n, prefix_chars, middle_chars) of every row; ``form``
    is plain, psm or spm, ``n`` the number of units.  ``turned_percent`` of the
    documents are turned, ``spm_percent`` of those as spm."""
    rows = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("key"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def one(key: str, data: bytes):
        h1, h2, h3, h4 = draws(key, seed)
        ends = unit_ends(data)
        n = len(ends)
        if not data or P in data or S in data or M in data or h3 % 100 >= turned_percent:
            return data, "plain", n, None, None
        low, high = (int(ends[k - 1]) if k else 0 for k in sorted((h1 % (n + 1), h2 % (n + 1))))
        form = "spm" if h4 % 100 < spm_percent else "psm"
        return bytes(arrange(data, low, high, form)), form, n, code_points(data, 0, low), code_points(data, low, high)

    def run(batches):
        for b in batches:
            held, size, first = [], 0, 0
            for i, (key, data) in enumerate(zip(b.column(1), _bytes(b.column(2)))):
                held.append(one(key.as_py(), data))
                size += len(held[-1][0])
                if len(held) >= _ROWS_OUT or size >= _BYTES_OUT:
                    yield _made(b.column(0).slice(first, len(held)), held)
                    held, size, first = [], 0, i + 1
            if held:
                yield _made(b.column(0).slice(first, len(held)), held)

    return rows.mapInArrow(run, f"doc_id {kind}, output string, form string, n long, prefix_chars long, middle_chars long")


def _made(ids: pa.Array, held: list[tuple]) -> pa.RecordBatch:
    output, form, n, prefix, middle = zip(*held)
    return pa.RecordBatch.from_arrays(
        [ids, _strings(list(output)), pa.array(form), pa.array(n, pa.int64()), pa.array(prefix, pa.int64()),
         pa.array(middle, pa.int64())], names=["doc_id", "output", "form", "n", "prefix_chars", "middle_chars"])


def restore(rows: DataFrame) -> DataFrame:
    """``rows`` with ``text``, rebuilt from their columns output and form alone."""
    own = [c for c in rows.columns if c != "text"]
    schema = rows.select(*own).schema.add("text", "string")

    def run(batches):
        for b in batches:
            held, size, first = [], 0, 0
            for i, (form, data) in enumerate(zip(b.column("form"), _bytes(b.column("output")))):
                held.append(recover(data, form.as_py()))
                size += len(held[-1])
                if size >= _BYTES_OUT or i + 1 == b.num_rows:
                    part = b.slice(first, len(held))
                    yield pa.RecordBatch.from_arrays([*part.columns, _strings(held)], names=[*own, "text"])
                    held, size, first = [], 0, i + 1

    return rows.select(*own).mapInArrow(run, schema)


def op11_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return restore(infill(documents(spark, sf_dir))).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("text", 256).alias("restored_sha256"))


_UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
_H = "CAST('0x' || substr(h, {}, 8) AS BIGINT)"
OP11_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_UNIT}') AS u,
             sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
c AS (SELECT doc_id, t, u, CAST(len(u) AS BIGINT) AS n, {_H.format(1)} % (len(u) + 1) AS c1,
        {_H.format(9)} % (len(u) + 1) AS c2, {_H.format(17)} % 100 AS c3, {_H.format(25)} % 100 AS c4 FROM d),
f AS (SELECT doc_id, t, n, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
          OR c3 >= {TURNED_PERCENT} THEN 'plain' WHEN c4 < {SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form,
        array_to_string(list_slice(u, 1, least(c1, c2)), '') AS p,
        array_to_string(list_slice(u, least(c1, c2) + 1, greatest(c1, c2)), '') AS m,
        array_to_string(list_slice(u, greatest(c1, c2) + 1, len(u)), '') AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256 FROM f
"""
