"""MinHash near-dedup (operator 8) with DartMinHash signatures.

A text's words (lower-cased, split at white space) give a multiset of five-word
shingles; texts of fewer words have one shingle of all their words.  Two texts
are linked when the weighted Jaccard similarity of their multisets is at least
0.8, and classes are the connected components of the links.

Signature.  Each shingle owns a region of weight x rank, cut into dyadic weight
blocks [0,1), [1,2), [2,4), ...  Darts hit a block as a Poisson process along
the rank axis, drawn from hashes of (shingle, block, dart number) alone, so all
texts see the same darts; a dart counts where its weight position is under the
shingle's count.  Each dart names one of K coordinates, and a coordinate keeps
its earliest dart.  A text looks at ranks up to about (K ln K + 3 K) / weight,
so the work is linear in its words plus K log K; texts with an empty coordinate
look twice as far.  Signatures are banded (BANDS x ROWS); a pair at similarity
0.8 misses every band with probability 2e-4, at 0.9 with 1e-9.

Links without all pairs.  Equal texts are merged first (128-bit hash) and one
row stands for them.  Texts in one band bucket form a group; ``groups.link_groups``
checks them exactly on the shingle multisets against a lead of their group, and
splits what is left by the rarest elements of the differences to that lead, so
that no link that shares a bucket is lost and no group's pairs are formed.

Hot groups: exact copies collapse in a partial aggregate; joins on a bucket or
copy key have written tables on both sides, so adaptive execution splits a hot
key.  Nothing is collected to the driver.  Tables of earlier steps are deleted
when the next is written.

Memory of a task: one block of ``_BLOCK_WORDS`` words or one longer text, cut
before any further text is split into words, and the bounded word cache.

Rows get a number when they are first written; a distinct text is the node of
buckets, checks and components, named by its least row number, and rows are
mapped to it at the end.  So null or repeated ids link nothing.

Defined results: null texts count as empty; texts without words are copies of
each other; the least doc_id of a class is its class_id (a null id is the least),
which classes share where their rows share an id: ``class_key``, the hash of the
kept row's text, tells them apart; one row of each class is kept, the least by
(doc_id, hash of the text); an empty table gives an empty table; extra columns
are passed by ``keep_first`` and not read otherwise.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specimen.llm.common import documents, drop_written, parity_sketches, written
from specimen.llm.groups import link_groups
from specimen.llm.wordhash import byte_blocks, mix as _mix, sorted_within, word_hashes

WORDS, THRESHOLD, BANDS, ROWS = 5, 0.8, 36, 7
K = BANDS * ROWS
_DARTS = K * (np.log(K) + 3)
_NULL_ID = -(1 << 63)
_U = np.uint64


def _unit(x: np.ndarray) -> np.ndarray:
    """(0, 1] from the upper 53 bits."""
    return ((x >> _U(11)).astype(np.float64) + 1.0) * 2.0 ** -53


def shingles(word_ids: np.ndarray, lengths: np.ndarray, n: int = WORDS):
    """Distinct (text, shingle, count) over texts concatenated in ``word_ids``."""
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
    h = np.zeros(len(word_ids), np.uint64)
    for j in range(n):
        h[:max(len(h) - j, 0)] += _mix(word_ids[j:] + _U(j + 1)) * _U(2 * j + 1)
    text = np.repeat(np.arange(len(lengths)), lengths)
    inside = np.arange(len(word_ids)) - starts[text] <= (lengths[text] - n)
    short = np.flatnonzero((lengths > 0) & (lengths < n))
    whole = np.zeros(len(short), np.uint64)
    for j in range(n - 1):
        has = lengths[short] > j
        whole[has] += _mix(word_ids[starts[short[has]] + j] + _U(j + 1)) * _U(2 * j + 1)
    s = _mix(np.concatenate([h[inside], whole]))
    t = np.concatenate([text[inside], short])
    order = sorted_within(t, s)
    s, t = s[order], t[order]
    new = np.flatnonzero(np.concatenate([[True], (s[1:] != s[:-1]) | (t[1:] != t[:-1])])) if len(s) else order
    return t[new], s[new], np.diff(np.append(new, len(s)))


def _throw(text, seed, low, width, count, limit, sig, rank):
    """Darts of all blocks up to each text's rank limit into sig and rank."""
    k, n = rank.shape[1], len(text)
    at, number = np.zeros(n), 0
    live = np.arange(n)
    step = int(max(1, np.ceil(np.median(limit[text] * width)))) if n else 1
    while len(live):
        j = (np.arange(step) + number).astype(np.uint64)
        dart = _mix(seed[live][:, None] + (j[None, :] + _U(1)) * _U(0x9E3779B97F4A7C15))
        r = at[live][:, None] + np.cumsum(-np.log(_unit(dart)) / width[live][:, None], axis=1)
        more = _mix(dart ^ _U(0x5851F42D4C957F2D))
        hit = (r <= limit[text[live]][:, None]) & (
            low[live][:, None] + _unit(more) * width[live][:, None] <= count[live][:, None])
        row, col = np.nonzero(hit)
        if len(row):
            key = text[live[row]] * k + (_mix(more[row, col] + _U(1)) % _U(k)).astype(np.int64)
            flat_rank, flat_sig, rk = rank.reshape(-1), sig.reshape(-1), r[row, col]
            np.minimum.at(flat_rank, key, rk)
            won = flat_rank[key] == rk
            flat_sig[key[won]] = dart[row[won], col[won]]
        at[live] = r[:, -1]
        number += step
        live = live[at[live] <= limit[text[live]]]


def signatures(text: np.ndarray, shingle: np.ndarray, count: np.ndarray, n: int, k: int = K) -> np.ndarray:
    """(n, k) DartMinHash signatures; texts without shingles get zeros."""
    t, s, low, width = [text], [shingle], [np.zeros(len(text))], [np.ones(len(text))]
    level = 1
    while level < (count.max() if len(count) else 0) * 2 and (has := count > level).any():
        t.append(text[has])
        s.append(_mix(shingle[has] + _U(level * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF)))
        low.append(np.full(has.sum(), float(level)))
        width.append(np.full(has.sum(), float(level)))
        level *= 2
    c = np.concatenate([count] + [count[count > 2 ** i] for i in range(len(t) - 1)]).astype(float)
    t, s, low, width = map(np.concatenate, (t, s, low, width))
    weight = np.bincount(text, count, n)
    sig, rank = np.zeros((n, k), np.uint64), np.full((n, k), np.inf)
    limit = np.where(weight > 0, k * (np.log(k) + 3) / np.maximum(weight, 1), 0.0)
    todo = weight > 0
    while todo.any():
        scale = np.where(todo, np.clip(np.ceil(np.log2(np.maximum(limit, 1e-9))), 0, 60).astype(int), -1)
        for level in np.unique(scale[todo]):
            use = scale[t] == level
            _throw(t[use], s[use], low[use], width[use], c[use], limit, sig, rank)
        todo &= np.isinf(rank).any(axis=1)
        sig[todo], rank[todo] = 0, np.inf
        limit[todo] *= 2
    return sig


def _bands(sig: np.ndarray) -> np.ndarray:
    s = sig.reshape(len(sig), BANDS, ROWS)
    key = np.zeros((len(sig), BANDS), np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)
    for j in range(ROWS):
        key = _mix(key * _U(0x9E3779B97F4A7C15) + s[:, :, j])
    return key.view(np.int64)


def _blocks(batch: pa.RecordBatch):
    """(ids, texts, word hashes, words of each text) of a batch, a block of bytes at a
    time; the texts are lower-cased, their words joined by one space."""
    for first, offsets, _ in byte_blocks(batch.column(1)):
        texts = [" ".join((v.as_py() or "").lower().split()).encode("utf-8", "surrogatepass")
                 for v in batch.column(1).slice(first, len(offsets) - 1)]
        ends = np.cumsum([0] + [len(t) for t in texts])
        yield (batch.column(0).slice(first, len(texts)), texts,
               *word_hashes(ends, np.frombuffer(b"".join(texts), np.uint8)))


def _sign(batches):
    import xxhash
    for batch in batches:
        for ids, rows, hashes, lengths in _blocks(batch):
            sig = signatures(*shingles(hashes, lengths), len(rows))
            raw = [xxhash.xxh3_128_digest(r) for r in rows]
            key = np.frombuffer(b"".join(raw), np.int64).reshape(-1, 2)
            bands = pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * BANDS,
                                             pa.array(_bands(sig).ravel()))
            weight = pa.array(np.maximum(lengths - WORDS + 1, np.minimum(lengths, 1)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(key[:, 0].copy()), pa.array(key[:, 1].copy()), weight, bands],
                names=["id", "h1", "h2", "weight", "bands"])


def _expand(batches):
    for batch in batches:
        for ids, rows, hashes, lengths in _blocks(batch):
            t, s, c = shingles(hashes, lengths)
            nth = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
            each = (_mix(np.repeat(s, c) + nth.astype(np.uint64) * _U(0x9E3779B97F4A7C15)) >> _U(32)).astype(np.uint32)
            t = np.repeat(t, c)
            order = sorted_within(t, each)
            t, each = t[order], each[order]
            # two 32-bit hashes may meet within one text: distinct items only
            new = np.append(True, (t[1:] != t[:-1]) | (each[1:] != each[:-1]))[:len(t)]
            t, each = t[new], each[new]
            sizes = np.bincount(t, minlength=len(rows))
            sets = pa.ListArray.from_arrays(np.append(0, np.cumsum(sizes)).astype(np.int32), pa.array(each.view(np.int32)))
            yield pa.RecordBatch.from_arrays([ids, sets, parity_sketches(t, each, len(rows))], names=["id", "items", "parity"])


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` written once with a number of each row, ``_nd_row``."""
    return written(docs.withColumn("_nd_row", F.monotonically_increasing_id()), "numbered")


def sketch(rows: DataFrame) -> DataFrame:
    """(id, h1, h2, weight, bands) of numbered rows, ``id`` the row's number: copy
    key, number of shingles and band keys."""
    return rows.select("_nd_row", "text").mapInArrow(_sign, "id long, h1 long, h2 long, weight int, bands array<long>")


def shingle_sets(rows: DataFrame) -> DataFrame:
    """(id, items, parity): 32-bit hashes of (shingle, n-th occurrence) of every numbered row,
    so that set similarity of the items is weighted similarity of the shingles; ``parity`` is their sketch."""
    return rows.select("_nd_row", "text").mapInArrow(_expand, "id long, items array<int>, parity array<long>")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, class_id, text_id, class_key, kept) of every row: ``text_id`` is the
    least doc_id with an equal text, ``class_id`` the least doc_id of the class,
    ``class_key`` the class's own, and ``kept`` holds for one row of each class."""
    return _classified(numbered(docs.select("doc_id", "text")), threshold).drop("_nd_row")


def _classified(docs: DataFrame, threshold: float) -> DataFrame:
    """The columns of ``near_duplicates`` and ``_nd_row`` for numbered ``docs``."""
    signed = written(sketch(docs), "signatures")
    copies = written(signed.groupBy("h1", "h2").agg(F.min("id").alias("node")), "copies")
    firsts = signed.join(copies.select(F.col("node").alias("id"), "h1", "h2"), ["id", "h1", "h2"], "left_semi")
    rows = written(firsts.select("id", F.explode("bands").alias("key")), "buckets")
    shared = written(rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key"), "shared-buckets")
    members = written(rows.join(shared, "key"), "members")
    wanted = members.select(F.col("id").alias("_nd_row")).distinct()
    # merge: the wanted rows grow with the input, so the join has one form at every size
    sets = written(shingle_sets(docs.join(wanted.hint("merge"), "_nd_row", "left_semi")), "sets")
    drop_written(rows, shared)
    share = Fraction(str(threshold))
    labels = link_groups(members, sets, share.numerator, share.denominator)
    drop_written(members, sets)
    if labels is None:
        labels = copies.select("node", F.col("node").alias("label")).limit(0)
    named = written(docs.select(
        F.col("_nd_row").alias("id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("doc"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("raw")).join(signed.select("id", "h1", "h2"), "id"), "named")
    # one row a text, then one a class: the least row stands first
    texts = written(named.groupBy("h1", "h2").agg(F.min(F.struct("doc", "raw", "id")).alias("_first"))
                    .join(copies, ["h1", "h2"]).join(labels, "node", "left")
                    .select("h1", "h2", F.coalesce("label", "node").alias("label"), "_first"), "texts")
    heads = written(texts.groupBy("label").agg(F.min("_first").alias("_head")), "heads")
    drop_written(signed, copies)
    texts = written(texts.join(heads, "label").select("h1", "h2", F.col("_first.doc").alias("text_id"), "_head"), "texts")
    return named.join(texts, ["h1", "h2"]).select(
        F.when(F.col("doc") != _NULL_ID, F.col("doc")).alias("doc_id"), F.col("_head.doc").alias("class_id"), "text_id",
        F.col("_head.raw").alias("class_key"), (F.col("id") == F.col("_head.id")).alias("kept"), F.col("id").alias("_nd_row"))


def keep_first(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of ``docs`` of each class, the least by doc_id and text hash."""
    rows = numbered(docs)
    kept = written(_classified(rows, threshold).filter("kept").select("_nd_row"), "kept")
    out = rows.join(kept.hint("merge"), "_nd_row", "left_semi")  # kept rows grow with the input: one form
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", "class_id", "kept", "class_key")
