"""Word hashes of whole blocks against words split one by one."""

import random

import numpy as np
import pyarrow as pa
import pytest

from specimen.llm import wordhash


def _texts(seed, n=60):
    pick = random.Random(seed)
    alphabet = ["a", "B", "b", "é", "日", " ", "\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\xa0", "longerthan8", "exactly8", "\x00"]
    return [None, "", " ", "x", "X", "a" * 17] + [
        "".join(pick.choices(alphabet, k=pick.randrange(40))) for _ in range(n)]


def _words(text):
    return (text or "").encode().lower().split()


@pytest.mark.parametrize("limit", [1, 64, 1 << 20])
@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_words_of_blocks(limit, kind):
    texts = _texts(limit)
    column = pa.array(["cut off"] + texts, kind).slice(1)
    seen, first = {}, 0
    for at, offsets, data in wordhash.byte_blocks(column, limit):
        assert at == first
        hashes, lengths = wordhash.word_hashes(offsets, data)
        some = [_words(t) for t in texts[first:first + len(lengths)]]
        assert lengths.tolist() == [len(w) for w in some]
        assert len(lengths) == 1 or len(data) <= limit
        for word, h in zip((w for ws in some for w in ws), hashes.tolist(), strict=True):
            assert seen.setdefault(word, h) == h
        first += len(lengths)
    assert first == len(texts)
    assert len(set(seen.values())) == len(seen)


def test_no_rows_and_null_bytes():
    assert list(wordhash.byte_blocks(pa.array([], pa.string()))) == []
    (_, offsets, data), = wordhash.byte_blocks(pa.array(["a a\x00 a\x00\x00 aaaaaaaa aaaaaaaa\x00"]))
    assert len(set(wordhash.word_hashes(offsets, data)[0].tolist())) == 5


def test_many_long_texts_make_many_blocks():
    column = pa.array(["word other " * 30_000] * 64)
    blocks = list(wordhash.byte_blocks(column))
    assert len(blocks) == 64 and all(len(b[2]) == 330_000 for b in blocks)


@pytest.mark.parametrize("groups", [3, 70_000])
def test_order_within_groups(groups):
    pick = np.random.default_rng(groups)
    group = np.sort(pick.integers(0, groups, 100_000))
    value = pick.integers(0, 1 << 63, 100_000).astype(np.uint64)
    order = wordhash.sorted_within(group, value)
    best = np.lexsort((value, group))
    assert (group[order] == group[best]).all() and (value[order] == value[best]).all()
