"""N-gram Jaccard join (operator 12): PartEnum signatures.

A text's words (split at ``[\\x20\\x09-\\x0D]``, A-Z lower-cased) give the set of its
distinct ``SHINGLE``-word shingles; a text of fewer words has one shingle of all.
Two sets link when ``100 * intersection >= 80 * union``; classes are the connected
components of the links.  The join is exact: no link is lost.

Sizes fall into bands [l, r] with r = floor(l / 0.8), the next from r + 1.  Linked
sets are in one band or in neighbouring ones, so a set has signatures for its own
band and for the next.  Sets of at most r elements that link differ in at most
k = floor(2 r (1 - 0.8) / (1 + 0.8)) elements.

PartEnum.  The shingles' domain is cut by a hash into n1 parts and each part into
n2 sub-parts.  Of n1 parts at most floor(k / (k2 + 1)) hold more than k2 of the k
differences; in any other part, n2 - k2 sub-parts agree.  A signature is a part
and a subset of n2 - k2 of its sub-parts: the hash of the set's elements there.
Bands up to k = ``RICH`` use k2 = 1 of n2 = 3 (three signatures a part, each over two
thirds of it); above, k2 = 0 and n2 = 1, one signature a part, the fewest there can be.

Empty subsets would put all sets into one group, so they give no signature.  A
part is weak for a set where some subset is empty; parts in reserve (an eighth or
a quarter more) make up for them: while a set has more than
n1 - 1 - floor(k / (k2 + 1)) weak parts, it adds the signatures of another hash
(``salt``).  Of two linked sets both have the signatures of every salt up to the
first at which either has enough parts, and there they share one.  After
``SALTS`` salts a set joins one group of all such sets of its band.

Sets with a signature in common form groups; ``groups.link_groups`` finds the
links in them exactly, without the pairs of a group.

Where the work is: passes over the texts (names and sizes; signatures; sketches of the
sets that share a signature; and, two or three times, shingles of the few sets that
sketches leave to be compared), one exchange of (signature, name)
rows, sent as arrays by bucket of signatures.  A set's name is a 64-bit hash of its sorted shingle hashes, so copies are
one node, whatever their ids.  Each task drops copies within its own batches and
keeps one row of every signature that repeats there for the common group; its
sets, known to be shared, are dealt over ``DEALS`` more keys, so that a hot group
meets in the exchange as a row per batch.  The later passes skip sets by a bit
table of fixed size (2 ** ``BITS`` bits) over the names wanted; what it lets through
in excess is more work only.

Defined results: null and empty texts have no shingle, n_shingles 0, and are
linked with nothing; their component is their own doc_id.  Rows that repeat a
doc_id are judged each on its own text; null ids are never the smallest of a
component (null where no row has one); an empty table gives no rows; extra
columns are not read.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from specimen.llm.common import documents, drop_written, fine_sketches, parity_sketches, written
from specimen.llm.groups import link_groups
from specimen.llm.wordhash import byte_blocks, mix as _mix, sorted_within, word_hashes

SHINGLE, NUM, DEN = 5, 80, 100
RICH, SALTS, DEALS, BITS = 8, 64, 63, 24
_ROWS_OUT = 400_000
_U = np.uint64


def bands(largest: int, num: int = NUM, den: int = DEN) -> np.ndarray:
    """Upper ends of the size bands up to ``largest``; the first is 0."""
    ends = [0]
    while ends[-1] < largest:
        ends.append((ends[-1] + 1) * den // num)
    return np.array(ends, np.int64)


@cache
def parts(r: int, num: int = NUM, den: int = DEN) -> tuple[int, int, int, int]:
    """(n1, n2, k2, weak parts allowed) of the band that ends at ``r``; n1 = 0 where
    only equal sets link."""
    k = 2 * r * (den - num) // (den + num)
    if k == 0:
        return 0, 1, 0, 0
    n2, k2 = (3, 1) if k <= RICH else (1, 0)
    need = k // (k2 + 1) + 1
    reserve = 1 + need // (4 if k2 else 8)
    return need + reserve, n2, k2, reserve


def signatures(doc: np.ndarray, shingle: np.ndarray, sizes: np.ndarray, num: int = NUM, den: int = DEN):
    """(doc, signature) rows of sets given as distinct (doc, shingle) sorted by doc;
    ``sizes``: elements of every doc."""
    ends = bands(int(sizes.max(initial=0)), num, den)
    own = np.searchsorted(ends, sizes)
    first = np.cumsum(sizes) - sizes
    out_doc, out_sig = [], []
    # one entry per set and band: the own band, and the next where a partner can be in it
    owner = np.concatenate([np.flatnonzero(sizes > 0), np.flatnonzero((sizes > 0) & (sizes * den >= num * (ends[own] + 1)))])
    band = own[owner]
    n_own = int((sizes > 0).sum())
    band[n_own:] += 1
    uppers = np.append(ends, (ends[-1] + 1) * den // num)
    table = np.array([parts(int(r), num, den) for r in uppers], np.int64).reshape(-1, 4)
    n1, n2, k2, spare = table[band].T
    live = np.flatnonzero(n1 > 0)
    for salt in range(SALTS + 1):
        if not len(live):
            break
        o, s1, s2, s3 = owner[live], n1[live], n2[live], k2[live]
        tag = _mix(band[live].astype(np.uint64) * _U(0x9E3779B97F4A7C15) + _U(salt + 1))
        if salt == SALTS:
            out_doc.append(o)
            out_sig.append(tag)
            break
        n = sizes[o]
        entry = np.repeat(np.arange(len(live)), n)
        element = shingle[np.arange(len(entry)) + np.repeat(first[o] - (np.cumsum(n) - n), n)]
        h = _mix(element ^ tag[entry])
        part = ((h >> _U(32)) % s1[entry].astype(np.uint64)).astype(np.int64)
        sub = ((h & _U(0xFFFFFFFF)) % s2[entry].astype(np.uint64)).astype(np.int64)
        start = np.cumsum(s1) - s1  # parts of all entries in a row, three sub-parts each
        at = start[entry] + part
        total = int(s1.sum())
        value = _mix(element + _U(0x632BE59BD9B4E019))
        sums, counts = np.zeros((3, total), np.uint64), np.zeros((3, total), np.int32)
        for j in range(3):
            use = sub == j
            if use.any():
                by = at[use]
                counts[j] = np.bincount(by, minlength=total)
                np.add.at(sums[j], by, value[use])
        of = np.repeat(np.arange(len(live)), s1)
        where = _mix(tag[of] + (np.arange(total) - start[of] + 1).astype(np.uint64) * _U(0xC2B2AE3D27D4EB4F))
        rich = s3[of] > 0
        whole, size = sums.sum(axis=0, dtype=np.uint64), counts.sum(axis=0)
        flat = np.flatnonzero(~rich & (size > 0))
        out_doc.append(o[of[flat]])
        out_sig.append(_mix(where[flat] + whole[flat]))
        for j in range(3):
            left = np.flatnonzero(rich & (size > counts[j]))
            out_doc.append(o[of[left]])
            out_sig.append(_mix(where[left] + _U(j + 1) + (whole[left] - sums[j][left])))
        weak = np.where(rich, (counts > 0).sum(axis=0) <= 1, size == 0)
        live = live[np.bincount(of, weak, len(live)) > spare[live]]
    if not out_doc:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(out_doc), np.concatenate(out_sig)


def shingle_sets(offsets: np.ndarray, data: np.ndarray, n: int = SHINGLE):
    """(doc, shingle, sizes): distinct shingle hashes of texts, by doc and hash."""
    ids, lengths = word_hashes(offsets, data)
    doc = np.repeat(np.arange(len(lengths)), lengths)
    room = np.minimum(lengths, n)[doc]  # words in a shingle of this doc
    number = np.arange(len(ids)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    inside = np.flatnonzero(number + room <= lengths[doc])
    h = room[inside].astype(np.uint64)
    for j in range(n):
        has = np.flatnonzero(j < room[inside])
        h[has] = _mix(h[has] * _U(0x9E3779B97F4A7C15) + ids[inside[has] + j])
    doc = doc[inside]
    order = sorted_within(doc, h)
    doc, h = doc[order], h[order]
    new = np.append(True, (doc[1:] != doc[:-1]) | (h[1:] != h[:-1]))[:len(doc)]
    return doc[new], h[new], np.bincount(doc[new], minlength=len(lengths))


def names(doc: np.ndarray, shingle: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit name of every set: the hash of its sorted shingle hashes."""
    import xxhash
    upto = np.cumsum(sizes)
    return np.array([xxhash.xxh3_64_intdigest(shingle[b - n:b].tobytes()) for b, n in zip(upto, sizes)],
                    np.uint64).view(np.int64)


def _named(batches):
    for batch in batches:
        for first, offsets, data in byte_blocks(batch.column(1)):
            doc, shingle, sizes = shingle_sets(offsets, data)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, len(sizes)), pa.array(names(doc, shingle, sizes)), pa.array(sizes, pa.int64())],
                names=["doc_id", "node", "n_shingles"])


def _distinct(offsets: np.ndarray, data: np.ndarray):
    """(doc, shingle, sizes, names) of the distinct non-empty sets among texts."""
    doc, shingle, sizes = shingle_sets(offsets, data)
    node = names(doc, shingle, sizes)
    _, one = np.unique(node, return_index=True)
    keep = np.zeros(len(sizes), bool)
    keep[one] = True
    keep &= sizes > 0
    number = np.cumsum(keep) - 1
    use = keep[doc]
    return number[doc[use]], shingle[use], sizes[keep], node[keep]


def _signed(num: int, den: int, buckets: int):
    """Signatures of all distinct sets, some ``_ROWS_OUT`` at a time, by bucket."""
    def run(batches):
        held_sig, held_node, size = [], [], 0
        for batch in batches:
            for _, offsets, data in byte_blocks(batch.column(0)):
                doc, shingle, sizes, node = _distinct(offsets, data)
                own, sig = signatures(doc, shingle, sizes, num, den)
                held_sig.append(sig.view(np.int64))
                held_node.append(node[own])
                size += len(sig)
                if size >= _ROWS_OUT:
                    yield _dealt(np.concatenate(held_sig), np.concatenate(held_node), buckets)
                    held_sig, held_node, size = [], [], 0
        if size:
            yield _dealt(np.concatenate(held_sig), np.concatenate(held_node), buckets)
    return run


def _dealt(sig: np.ndarray, node: np.ndarray, buckets: int) -> pa.RecordBatch:
    """(bucket, sigs, homes, nodes) rows.  The first set of every signature here goes
    to the signature's bucket; signatures of several sets go, with all of them, to
    other buckets as well, dealt by signature and set, with the signature's own bucket
    in ``homes`` (else null).  Of a signature 32 bits are sent: with its bucket, which
    are as many as the input needs, they tell as good as all apart, and two that meet
    only make one group of two."""
    order = np.lexsort((node, sig))
    sig, node = sig[order], node[order]
    new = np.append(True, (sig[1:] != sig[:-1]) | (node[1:] != node[:-1]))
    sig, node = sig[new], node[new]
    first = np.append(True, sig[1:] != sig[:-1])
    more = ~first | np.append(~first[1:], False)
    deal = 1 + (node[more].view(np.uint64) >> _U(7)) % _U(DEALS)
    key = np.concatenate([sig[first].view(np.uint64), _mix(sig[more].view(np.uint64) + deal)])
    shared = np.repeat([False, True], [int(first.sum()), int(more.sum())])
    sig, node = np.concatenate([sig[first], sig[more]]), np.concatenate([node[first], node[more]])
    home, bucket = ((_mix(k) % _U(buckets)).astype(np.int32) for k in (sig.view(np.uint64), key))
    order = np.lexsort((node, shared, bucket))  # equal names side by side
    sig, node, shared, bucket, home = sig[order].astype(np.int32), node[order], shared[order], bucket[order], home[order]
    head = np.flatnonzero(np.append(True, (bucket[1:] != bucket[:-1]) | (shared[1:] != shared[:-1])))
    upto = np.append(head, len(sig)).astype(np.int32)
    homes = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(shared))[upto].astype(np.int32),
                                              mask=np.append(~shared[head], False)), pa.array(home[shared]))
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[head]), pa.ListArray.from_arrays(pa.array(upto), pa.array(sig)), homes,
         pa.ListArray.from_arrays(pa.array(upto), pa.array(node))], names=["bucket", "sigs", "homes", "nodes"])


def candidate_groups(docs: DataFrame, num: int = NUM, den: int = DEN) -> DataFrame:
    """Distinct (key, id): sets (by name) that share a signature with another set."""
    buckets = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = docs.select("text").mapInArrow(
        _signed(num, den, buckets), "bucket int, sigs array<int>, homes array<int>, nodes array<long>").repartition("bucket")
    lists = F.arrays_zip("sigs", F.coalesce("homes", F.array().cast("array<int>")).alias("homes"), "nodes")
    rows = packed.select("bucket", F.col("homes").isNotNull().alias("shared"), F.explode(lists).alias("x")).select(
        "bucket", "shared", F.shiftleft(F.coalesce("x.homes", "bucket").cast("long"), 32).bitwiseOR(
            F.col("x.sigs").cast("long").bitwiseAND(0xFFFFFFFF)).alias("sig"), F.col("x.nodes").alias("node"))
    w = Window.partitionBy("bucket", "sig").orderBy("node")  # clustered by bucket already
    near = rows.withColumns({"_before": F.lag("node").over(w), "_after": F.lead("node").over(w)})
    # equal names side by side are copies from other tasks
    near = near.filter(F.col("shared") | (F.col("_before") != F.col("node")) | (F.col("_after") != F.col("node")))
    return near.select(F.col("sig").alias("key"), F.col("node").alias("id")).distinct()


def _bit_table(ids: DataFrame, bits: int) -> np.ndarray:
    """A table of 2 ** ``bits`` bits with those of the names ``ids`` set."""
    place = F.col("id").bitwiseAND((1 << bits) - 1)
    one = F.expr("shiftleft(1L, cast(_place & 63 as int))")
    rows = ids.select(place.alias("_place")).groupBy(F.shiftright("_place", 6).alias("at")).agg(
        F.bit_or(one).alias("bits")).toArrow()  # at most 2 ** (bits - 6) rows
    table = np.zeros(1 << (bits - 6), np.int64)
    table[rows.column("at").to_numpy()] = rows.column("bits").to_numpy()
    return table


ITEMS = {"items": "array<long>"}
SKETCHES = {"size": "long", "parity": "array<long>", "fine": "array<long>"}


def named_sets(docs: DataFrame, ids: DataFrame, columns: dict[str, str] = ITEMS | SKETCHES, bits: int = BITS) -> DataFrame:
    """``id`` and ``columns`` of the sets named in ``ids`` (and few others): distinct shingle
    hashes, their number and their sketches."""
    table = _bit_table(ids, bits)
    if not table.any():
        docs = docs.limit(0)  # no pass over the texts

    def run(batches):
        for batch in batches:
            for _, offsets, data in byte_blocks(batch.column(0)):
                doc, shingle, sizes, node = _distinct(offsets, data)
                place = node & ((1 << bits) - 1)
                keep = (table[place >> 6] >> (place & 63)) & 1 == 1
                upto = np.append(0, np.cumsum(sizes[keep])).astype(np.int32)
                use = keep[doc]
                number = (np.cumsum(keep) - 1)[doc[use]]
                made = {"id": pa.array(node[keep])}
                if "items" in columns:
                    made["items"] = pa.ListArray.from_arrays(pa.array(upto), pa.array(shingle[use].view(np.int64)))
                if "size" in columns:
                    made |= {"size": pa.array(sizes[keep], pa.int64()), "fine": fine_sketches(number, shingle[use], sizes[keep]),
                             "parity": parity_sketches(number, shingle[use], int(keep.sum()))}
                yield pa.RecordBatch.from_arrays([made[c] for c in ("id", *columns)], names=["id", *columns])

    made = docs.select("text").mapInArrow(run, ", ".join(f"{c} {kind}" for c, kind in ({"id": "long"} | columns).items()))
    return made.groupBy("id").agg(*[F.first(c).alias(c) for c in columns])


def jaccard_components(docs: DataFrame, num: int = NUM, den: int = DEN) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row: the smallest doc_id that links
    reach from it."""
    if not 0 < num < den:
        raise ValueError("the similarity must be between 0 and 1")
    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = written(docs.mapInArrow(_named, f"doc_id {kind}, node long, n_shingles long"), "names")
    members = written(candidate_groups(docs, num, den), "members")
    ids = written(members.select("id").distinct(), "wanted")
    sets = written(named_sets(docs, ids, SKETCHES), "sets")
    labels = link_groups(members, sets, num, den, lambda some: written(named_sets(docs, some, ITEMS), "items"))
    drop_written(members, ids, sets)
    least = rows.filter("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("least"))
    if labels is not None:
        least = least.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    else:
        least = least.withColumn("label", F.col("node"))
    least = written(least, "least")
    heads = written(least.groupBy("label").agg(F.min("least").alias("component_id")), "heads")
    nodes = written(least.join(heads, "label").select("node", "component_id"), "components")
    drop_written(labels, least, heads)
    full = rows.filter("n_shingles > 0").join(nodes, "node").select("doc_id", "n_shingles", "component_id")
    return full.unionByName(rows.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir))
