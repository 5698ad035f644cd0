"""Fill-in-middle against a plain version, exact round trips, edge rows."""

from __future__ import annotations

import hashlib
import re

import numpy as np
from hypothesis import given, settings, strategies as st

from specimen.llm import infill

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain(doc_id, text, turned=50, spm=80):
    """(output, form, n, prefix_chars, middle_chars) by slicing."""
    text, key = text or "", "" if doc_id is None else str(doc_id)
    h = hashlib.sha256(f"42:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    units = UNIT.findall(text)
    n = len(units)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= turned:
        return text, "plain", n, None, None
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm:
        return f"<S>{s}<P>{p}<M>{m}", "spm", n, len(p), len(m)
    return f"<P>{p}<S>{s}<M>{m}", "psm", n, len(p), len(m)


def test_query_columns_on_edges_and_documents(edge_docs, small_docs):
    for docs in (edge_docs, small_docs):
        for turned, spm in ((50, 80), (100, 50)):
            out = infill.restore(infill.infill(docs, turned_percent=turned, spm_percent=spm)).collect()
            want = sorted(((r.doc_id, *plain(r.doc_id, r.text, turned, spm), r.text or "") for r in docs.collect()), key=str)
            got = sorted(((r.doc_id, r.output, r.form, r.n, r.prefix_chars, r.middle_chars, r.text) for r in out), key=str)
            assert got == want


def test_sentinels_stay_plain_and_odd_white_space(spark):
    texts = ["a <P> b", "<M>", "<S><S>", "< P>", "<", "S> <", " \t lead", "end \n", "\x1c not\x85 white", "日本 語 é\n", " ", "x"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 20)], "doc_id int, text string")
    out = infill.restore(infill.infill(docs, turned_percent=100)).collect()
    assert {(r.doc_id, r.output, r.form, r.n, r.prefix_chars, r.middle_chars) for r in out} == {
        (i, *plain(i, t, 100)) for i, t in enumerate(texts * 20)}
    assert all(r.text == texts[r.doc_id % len(texts)] for r in out)


def test_empty_table(empty_docs):
    assert infill.restore(infill.infill(empty_docs)).count() == 0


def test_extra_columns_do_not_clash(spark):
    docs = spark.createDataFrame([(1, "a b c", "x", 9, "z")], "doc_id long, text string, form string, n long, output string")
    row = infill.restore(infill.infill(docs)).first()
    assert row.n == 3 and row.text == "a b c"


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=300), st.integers(0, 300), st.integers(0, 300), st.sampled_from(["psm", "spm"]))
def test_round_trip_of_any_bytes(data, a, b, form):
    if any(s in data for s in (infill.P, infill.S, infill.M)):
        return
    low, high = sorted((min(a, len(data)), min(b, len(data))))
    assert infill.recover(bytes(infill.arrange(data, low, high, form)), form) == data


def test_rotation_of_blocks_longer_than_a_piece():
    rng = np.random.default_rng(2)
    data = rng.integers(0, 256, 5 * infill._SWAP + 17, np.uint8).tobytes()
    for a, b, c in ((0, 1, len(data)), (3, 2 * infill._SWAP, 3 * infill._SWAP + 1), (7, 7, 9), (5, len(data), len(data))):
        buf = bytearray(data)
        infill.rotate(buf, a, b, c)
        assert bytes(buf) == data[:a] + data[b:c] + data[a:b] + data[c:]


def test_very_long_texts_in_one_batch(spark):
    rows = [(i, f"w{i} " * (40_000 + i)) for i in range(40)]
    out = infill.restore(infill.infill(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))).collect()
    assert {(r.doc_id, r.output, r.form) for r in out} == {(i, *plain(i, t)[:2]) for i, t in rows}
    assert all(r.text == rows[r.doc_id][1] for r in out)
