"""Runs against brute force over all periods, planted tails, edge rows."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pytest

from specimen.llm import periodic

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(w, min_length=6, min_periods=4):
    """(start, length, period) by trying every period, smallest first."""
    found = set()
    for q in range(1, len(w) // min_periods + 1):
        j = 0
        while j + q < len(w):
            s = j
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            n = j + q - s
            if j > s and n >= max(min_length, min_periods * q) and not any((s, n, p) in found for p in range(1, q)):
                found.add((s, n, q))
            j += 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    """The query's row of one document."""
    w = WORD.findall(text or "")
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    gone = {i for s, k, q in runs for i in range(s + q, s + k)}
    best = min(((-k, s, q) for s, k, q in runs), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *((best[1], -best[0], best[2], -1000 * best[0] // best[2]) if best else (None,) * 4),
            sha("".join(f"{s},{k},{q}\n" for s, k, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def query_rows(docs):
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    return sorted((tuple(r[c] for c in names) for r in periodic.digest(periodic.with_planted_runs(docs)).collect()), key=str)


@pytest.mark.parametrize("seed", range(4))
def test_runs_of_random_words(seed):
    rng = np.random.default_rng(seed)
    for _ in range(150):
        texts = []
        for _ in range(int(rng.integers(1, 6))):
            t = rng.integers(0, int(rng.integers(1, 5)), int(rng.integers(0, 60)))
            if rng.random() < 0.5 and len(t) > 10:
                s, q = int(rng.integers(0, len(t) - 5)), int(rng.integers(1, 6))
                t[s:] = t[s + (np.arange(len(t) - s) % q)]
            texts.append(t)
        length, periods = int(rng.integers(2, 8)), int(rng.integers(2, 5))
        sizes = [len(t) for t in texts]
        at = np.cumsum([0, *sizes])
        got = periodic.find_runs(np.repeat(np.arange(len(texts)), sizes), np.concatenate(texts).astype(np.int64), length, periods)
        want = [(s + at[i], k, q) for i, t in enumerate(texts) for s, k, q in plain_runs(list(t), length, periods)]
        assert sorted(map(tuple, got.T.tolist())) == sorted(want)


def test_query_on_documents(small_docs, edge_docs):
    for docs in (small_docs, edge_docs):
        rows = [r for r in docs.collect() if len(r.text or "") < 60_000]
        want = sorted((plain_row(r.doc_id, r.text) for r in rows), key=str)
        got = [r for r in query_rows(docs)]
        assert [r for r in got if r in set(want)] == want and len(got) == docs.count()


def test_long_and_null_texts(spark, empty_docs):
    rows = [(None, "a " * 20), (1, "a b " * 100_000), (2, None), (3, ""), (4, "  \n\t"), (5, "x"), (1, "a a a a a a"),
            (6, " ".join(f"w{i}" for i in range(30_000)) + " end" * 6)]
    docs = spark.createDataFrame([(*r, 1, "s") for r in rows], "doc_id long, text string, n_words long, runs string").coalesce(1)
    out = {(r.doc_id, r.n_words): r for r in periodic.periodic_runs(docs).collect()}
    run = lambda d, n: [tuple(x) for x in out[d, n].runs]
    assert run(None, 20) == [(0, 20, 1)] and out[None, 20].collapsed == "a"
    assert run(1, 200_000) == [(0, 200_000, 2)] and out[1, 200_000].collapsed == "a b"
    assert run(2, 0) == run(3, 0) == run(4, 0) == run(5, 1) == [] and out[5, 1].collapsed == "x"
    assert run(1, 6) == [(0, 6, 1)]
    assert run(6, 30_006) == [(30_000, 6, 1)] and out[6, 30_006].collapsed.endswith("w29999 end")
    assert periodic.digest(periodic.with_planted_runs(empty_docs)).count() == 0


def test_blocks_do_not_change_results(small_docs, monkeypatch):
    rows = [(r.doc_id, (r.text or "").encode().split()) for r in small_docs.collect()]
    def runs(size):
        out = []
        for at in range(0, len(rows), size):
            part = [w for _, w in rows[at:at + size]]
            out += periodic._block(None_ids(len(part)), part, 4, 2).column(2).to_pylist()
        return out
    assert runs(1) == runs(7) == runs(len(rows))


def None_ids(n):
    import pyarrow as pa
    return pa.nulls(n, pa.int64())
