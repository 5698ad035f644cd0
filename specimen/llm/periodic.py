"""Periodic run detection (operator 13): branching tandem repeats from an
enhanced suffix array.

A run is a maximal stretch of consecutive words with smallest period q, at least
``min_periods`` periods and ``min_length`` words long; runs may overlap.

Texts are handled in blocks of several, as one array of symbols that no two
texts share.  ``_suffixes`` sorts the suffixes by prefix doubling and keeps the
rank array of every doubled length; the rank of the full length is the inverse
suffix array (ISA).  Common prefixes of neighbours (LCP) and matches to the left
are read off the rank arrays, the longest lengths first.  LCP intervals come
from next and previous smaller values, as plain index ranges: no tree is built.
For every interval of depth d, the suffixes i of each child with at most half of
the interval's suffixes are tested: where ISA[i + d] or ISA[i - d] lies in the
interval but outside the child, the two positions start equal blocks of d words
followed by different ones, a branching tandem repeat.  Such a square ends its
run; rotated to the left as far as words repeat, it gives the whole run.  Squares
of several periods of one run have the same ends: the smallest is its period.

Two exact shortcuts: a word of a run occurs at least ``min_periods`` times in the
stretch around it, so rarer words cut the text into shorter stretches (repeated
until nothing changes) before suffixes are sorted; and an interval of fewer than
``min_periods`` suffixes belongs to no run.

Row-wise ``mapInArrow`` without an exchange; memory is that of one block of
``BLOCK_WORDS`` words, or of one longer text.

Defined results: null and empty texts have no words and no runs; a null doc_id
stays null; rows that repeat a doc_id are judged each on its own; an empty table
gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from specimen.llm.common import documents, id_crc, words

MIN_LENGTH, MIN_PERIODS = 6, 4
BLOCK_WORDS = 60_000
_EXPAND = 1 << 20
_RUN = "array<struct<start:long,length:long,period:long>>"


def _suffixes(symbols: np.ndarray) -> list[np.ndarray]:
    """Rank arrays of the prefixes of 1, 2, 4, ... symbols, the last without ties;
    a rank is the place of the first suffix of its group.  One more entry, -1,
    stands for the end."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    new = np.append(True, symbols[order[1:]] != symbols[order[:-1]])
    rank = np.full(n + 1, -1, np.int32)
    rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
    levels, step = [rank], 1
    tied = order[~(new & np.append(new[1:], True))]
    while len(tied):
        first = rank[tied].astype(np.int64)
        key = first * (n + 1) + rank[np.minimum(tied + step, n)] + 1
        by = np.argsort(key, kind="stable")
        tied, key, first = tied[by], key[by], first[by]
        new = np.append(True, key[1:] != key[:-1])
        group = np.append(True, first[1:] != first[:-1])
        at = np.arange(len(tied))
        rank = rank.copy()
        rank[tied] = first + np.maximum.accumulate(np.where(new, at, 0)) - np.maximum.accumulate(np.where(group, at, 0))
        levels.append(rank)
        tied = tied[~(new & np.append(new[1:], True))]
        step *= 2
    return levels


def _next_smaller(values: np.ndarray, or_equal: bool) -> np.ndarray:
    """For every place the next one with a smaller (or equal) value, else the length."""
    n = len(values)
    v, ahead = np.append(values, -1), np.minimum(np.arange(1, n + 2), n)
    todo = np.arange(n)
    while len(todo):
        other = v[ahead[todo]]
        todo = todo[other > v[todo] if or_equal else other >= v[todo]]
        ahead[todo] = ahead[ahead[todo]]
    return ahead[:n]


def _previous_smaller(values: np.ndarray, or_equal: bool) -> np.ndarray:
    return len(values) - 1 - _next_smaller(values[::-1], or_equal)[::-1]


def _tandems(levels: list[np.ndarray], min_size: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of branching tandem repeats in intervals of ``min_size`` suffixes."""
    isa = levels[-1]
    n = len(isa) - 1
    suffix = np.empty(n, np.int64)
    suffix[isa[:n]] = np.arange(n)
    lcp = np.zeros(n, np.int64)
    i, j = suffix[:-1].copy(), suffix[1:].copy()
    for k in range(len(levels) - 2, -1, -1):
        same = levels[k][i] == levels[k][j]
        i[same] += 1 << k
        j[same] += 1 << k
        lcp[1:][same] += 1 << k
    inner = np.flatnonzero(lcp)
    left, right = _previous_smaller(lcp, False), _next_smaller(lcp, False)
    after, before = _next_smaller(lcp, True), _previous_smaller(lcp, True)
    # the child right of every border, and the one left of an interval's first border
    first = inner[before[inner] == left[inner]]
    border = np.concatenate([inner, first])
    low = np.concatenate([inner, left[first]])
    size = np.concatenate([after[inner], first]) - low
    whole = right[border] - left[border]
    small = np.flatnonzero((2 * size <= whole) & (whole >= min_size))
    border, low, size = border[small], low[small], size[small]
    found = [np.zeros((2, 0), np.int64)]
    total = np.cumsum(size)
    at = 0
    while at < len(size):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + _EXPAND, "right")))
        own = np.repeat(np.arange(at, to), size[at:to])
        place = low[own] + np.arange(len(own)) - np.repeat(np.cumsum(size[at:to]) - size[at:to], size[at:to])
        d, l, r = lcp[border[own]], left[border[own]], right[border[own]]
        start, end = low[own], low[own] + size[own]
        for sign in (1, -1):
            other = suffix[place] + sign * d
            rank = isa[np.where(other < 0, n, np.minimum(other, n))]
            hit = (rank >= l) & (rank < r) & ((rank < start) | (rank >= end))
            found.append(np.stack([np.minimum(suffix[place], other)[hit], d[hit]]))
        at = to
    return tuple(np.unique(np.concatenate(found, axis=1), axis=1))


def _stretches(text: np.ndarray, codes: np.ndarray, min_length: int, min_periods: int):
    """(place, symbol) of the words that can be in a run: stretches in which every
    word occurs ``min_periods`` times; symbols tell stretches apart."""
    place, part = np.arange(len(codes)), text
    while len(place):
        order = np.lexsort((codes[place], part))
        p, c = part[order], codes[place][order]
        new = np.append(True, (p[1:] != p[:-1]) | (c[1:] != c[:-1]))
        symbol = np.empty(len(place), np.int64)
        symbol[order] = np.cumsum(new) - 1
        keep = np.bincount(symbol)[symbol] >= min_periods
        at, part_at = place[keep], part[keep]
        new = np.append(True, (at[1:] != at[:-1] + 1) | (part_at[1:] != part_at[:-1]))[:len(at)]
        stretch = np.cumsum(new) - 1
        long = np.bincount(stretch)[stretch] >= min_length if len(at) else keep[:0]
        if len(at) == len(place) and long.all():
            return place, symbol
        place, part = at[long], stretch[long]
    return place, place


def find_runs(text: np.ndarray, codes: np.ndarray, min_length: int = MIN_LENGTH,
              min_periods: int = MIN_PERIODS) -> np.ndarray:
    """(start, length, period) columns of all runs of word ``codes``, by start and
    period; ``text`` (not decreasing) tells texts apart, starts count from 0."""
    place, symbol = _stretches(text, codes, min_length, min_periods)
    if not len(place):
        return np.zeros((3, 0), np.int64)
    levels = _suffixes(symbol)
    start, period = _tandems(levels, min_periods)
    end = start + 2 * period
    for k in range(len(levels) - 2, -1, -1):
        to = start - (1 << k)
        to = np.where(to >= 0, to, len(symbol))
        same = levels[k][to] == levels[k][np.minimum(to + period, len(symbol))]
        same &= to < len(symbol)
        start = np.where(same, to, start)
    length = end - start
    long = length >= np.maximum(min_length, min_periods * period)
    start, length, period = start[long], length[long], period[long]
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    new = np.append(True, (start[1:] != start[:-1]) | (length[1:] != length[:-1]))[:len(start)]
    start, length, period = place[start[new]], length[new], period[new]
    order = np.lexsort((period, start))
    return np.stack([start[order], length[order], period[order]])


def _block(ids: pa.Array, rows: list[list[bytes]], min_length: int, min_periods: int) -> pa.RecordBatch:
    sizes = np.array([len(r) for r in rows], np.int64)
    first = np.append(0, np.cumsum(sizes))
    known: defaultdict = defaultdict()
    known.default_factory = known.__len__
    codes = np.fromiter(map(known.__getitem__, (w for r in rows for w in r)), np.int64, int(first[-1]))
    text = np.repeat(np.arange(len(rows)), sizes)
    start, length, period = find_runs(text, codes, min_length, min_periods)
    edge = np.zeros(len(codes) + 1, np.int64)
    np.add.at(edge, start + period, 1)
    np.add.at(edge, start + length, -1)
    gone = np.cumsum(edge)[:-1] > 0
    own = text[start]
    upto = np.searchsorted(own, np.arange(len(rows) + 1)).astype(np.int32)
    kept = [r if upto[k] == upto[k + 1] else [w for w, g in zip(r, gone[first[k]:first[k + 1]]) if not g]
            for k, r in enumerate(rows)]
    runs = pa.StructArray.from_arrays([pa.array(start - first[own]), pa.array(length), pa.array(period)],
                                      names=["start", "length", "period"])
    joined = pa.array([b" ".join(r) for r in kept], pa.binary())
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(sizes), pa.ListArray.from_arrays(pa.array(upto), runs),
         pa.Array.from_buffers(pa.string(), len(joined), joined.buffers())],
        names=["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row: ``runs`` by start and period,
    ``collapsed`` the words left when every run keeps its first period only."""
    if min_periods < 2:
        raise ValueError("a run has two periods at least")
    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            held, size, first = [], 0, 0
            for i, v in enumerate(b.column(1).cast(pa.binary())):
                row = (v.as_py() or b"").split()  # ASCII white space: the six characters
                if held and size + len(row) > BLOCK_WORDS:
                    yield _block(b.column(0).slice(first, len(held)), held, min_length, min_periods)
                    held, size, first = [], 0, i
                held.append(row)
                size += len(row)
            if held:
                yield _block(b.column(0).slice(first, len(held)), held, min_length, min_periods)

    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, runs {_RUN}, collapsed string")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with the tail of every tenth document, by the hash of its
    id, made periodic; other texts as they are."""
    h = id_crc(F.col("doc_id"))
    g = F.floor(h / 10)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), h.alias("_h"), g.alias("_g"))
    rows = rows.withColumn("_w", F.when(F.col("_h") % 10 == 0, words(F.col("text"))))
    n = F.size("_w")
    rows = rows.withColumn("_n", n).withColumn("_a", F.when(F.col("_n") > 0, F.col("_g") % F.col("_n")).cast("int"))
    rows = rows.withColumn("_p", (1 + F.floor((F.col("_n") - F.col("_a")) / (3 + F.col("_g") % 8))).cast("int"))
    root = F.slice("_w", F.col("_a") + 1, F.col("_p"))
    times = F.ceil((F.col("_n") - F.col("_a")) / F.col("_p")).cast("int")
    made = F.slice(F.concat(F.slice("_w", F.lit(1), F.col("_a")), F.flatten(F.array_repeat(root, times))),
                   F.lit(1), F.col("_n"))
    return rows.select("doc_id", F.when(F.col("_n") > 0, F.array_join(made, " ")).otherwise(F.col("text")).alias("text"))


def _longest(runs: str) -> Column:
    return F.array_min(F.transform(runs, lambda r: F.struct(
        (-r["length"]).alias("_l"), r["start"].alias("start"), r["period"].alias("period"), r["length"].alias("length"))))


def digest(rows: DataFrame) -> DataFrame:
    """The query's columns from the runs of ``rows`` (doc_id, text)."""
    rows = periodic_runs(rows)
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"),
        F.lit("\n"))), "")
    best = _longest("runs")
    thousand = 1000 * best["length"]
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"),
        best["length"].alias("length"), best["period"].alias("period"),
        ((thousand - thousand % best["period"]) / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(with_planted_runs(documents(spark, sf_dir)))
