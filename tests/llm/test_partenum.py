"""The join against all pairs, PartEnum's guarantee, hot groups, edge rows."""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pytest

from specimen.llm import partenum
from specimen.llm.common import fine_sketches, parity_sketches, written
from specimen.llm.groups import link_groups

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_set(text):
    w = WORD.findall(re.sub("[A-Z]+", lambda m: m.group().lower(), text or ""))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def plain_join(rows, num=80, den=100):
    """(doc_id, n_shingles, component_id) by comparing all sets that share a shingle."""
    sets = [plain_set(t) for _, t in rows]
    holders, root = defaultdict(list), list(range(len(rows)))
    def find(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x
    for i, s in enumerate(sets):
        common = defaultdict(int)
        for x in s:
            for j in holders[x]:
                common[j] += 1
            holders[x].append(i)
        for j, c in common.items():
            if den * c >= num * (len(s) + len(sets[j]) - c):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


def joined(docs, **how):
    return sorted((tuple(r) for r in partenum.jaccard_components(docs, **how).collect()), key=str)


def edited(rng, words, n, vocabulary=5_000):
    w = list(words)
    for _ in range(n):
        i = int(rng.integers(0, len(w)))
        kind = rng.integers(0, 3)
        if kind == 0 and len(w) > 1:
            del w[i]
        elif kind == 1:
            w.insert(i, f"n{rng.integers(0, vocabulary)}")
        else:
            w[i] = f"n{rng.integers(0, vocabulary)}"
    return w


def copies_of(rng, sizes, copies, most, vocabulary=5_000):
    rows = []
    for n in sizes:
        base = [f"v{x}" for x in rng.integers(0, 400, n)]
        for _ in range(copies):
            rows.append((len(rows) * 7 % 100_003, " ".join(edited(rng, base, int(rng.integers(0, most(n) + 1)), vocabulary))))
    return rows


@pytest.mark.parametrize("which", ["edge_docs", "small_docs"])
def test_documents(which, request):
    docs = request.getfixturevalue(which)
    assert joined(docs) == plain_join([(r.doc_id, r.text) for r in docs.collect()])


def test_copies_of_all_sizes(spark):
    rng = np.random.default_rng(4)
    rows = copies_of(rng, [1, 2, 3, 4, 5, 6, 7, 8, 9, 11, 14, 18, 25, 33, 50, 90, 150, 400, 1200], 24, lambda n: max(1, n // 22))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert joined(docs) == plain_join(rows)


def test_other_thresholds(spark):
    rng = np.random.default_rng(5)
    rows = copies_of(rng, [6, 20, 60, 200], 20, lambda n: max(1, n // 9))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for num in (60, 95):
        assert joined(docs, num=num) == plain_join(rows, num)


def test_signatures_are_shared_by_all_linked_sets():
    rng = np.random.default_rng(6)
    for _ in range(300):
        n = int(rng.integers(3, 260))
        a = rng.choice(1 << 62, n, replace=False).astype(np.uint64)
        out = int(rng.integers(0, n // 5 + 1))
        b = np.concatenate([a[out:], rng.integers(0, 1 << 62, int(rng.integers(0, n // 6 + 1))).astype(np.uint64)])
        c = len(np.intersect1d(a, b))
        if 100 * c < 80 * (len(a) + len(b) - c):
            continue
        doc = np.repeat([0, 1], [len(a), len(b)])
        own, sig = partenum.signatures(doc, np.concatenate([np.sort(a), np.sort(b)]), np.array([len(a), len(b)]))
        if len(a) == len(b) == c:
            continue  # equal sets are one node
        assert set(sig[own == 0].tolist()) & set(sig[own == 1].tolist()), (len(a), len(b), c)


@pytest.mark.parametrize("n", [100, 400])
def test_near_copies_of_one_text(spark, n, monkeypatch):
    """Copies with many edits of their own: many groups, few links; pairs checked grow
    with the copies, not with their square."""
    from specimen.llm import groups
    rng = np.random.default_rng(7)
    rows = copies_of(rng, [150], n, lambda _: 14, 10**9)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    seen, plain = [], groups.checked
    def counted(pairs, *a):
        seen.append(pairs.count())
        return plain(pairs, *a)
    monkeypatch.setattr(groups, "checked", counted)
    assert joined(docs) == plain_join(rows)
    assert sum(seen) <= 25 * n, seen


def test_no_link_is_lost_inside_a_group(spark, monkeypatch):
    """All sets in one group, of several templates, compared without a split or after
    several: the links found are all pairs' links."""
    from specimen.llm import groups
    rng = np.random.default_rng(8)
    for trial, small in enumerate((512, 40, 4)):
        monkeypatch.setattr(groups, "SMALL", small)
        core = rng.choice(1 << 40, 30, replace=False)
        sets = []
        for _ in range(6):
            template = np.concatenate([core, rng.choice(1 << 40, 30 + 30 * trial)])
            for _ in range(25):
                keep = template[rng.random(len(template)) > rng.choice([0.02, 0.05, 0.12])]
                sets.append(sorted(set(np.append(keep, rng.choice(1 << 40, int(rng.integers(0, 9)))).tolist())))
        doc = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        parity = parity_sketches(doc, np.concatenate([np.array(x) for x in sets]), len(sets)).to_pylist()
        table = written(spark.createDataFrame([(i, x, p) for i, (x, p) in enumerate(zip(sets, parity))],
                                              "id long, items array<long>, parity array<long>"), "test-sets")
        members = written(table.selectExpr("1L as key", "id"), "test-members")
        labels = link_groups(members, table, 80, 100)
        got = {r.node: r.label for r in labels.collect()}
        root = list(range(len(sets)))
        def find(x):
            while root[x] != x:
                x = root[x]
            return x
        for i, a in enumerate(sets):
            for j in range(i):
                c = len(set(a) & set(sets[j]))
                if 100 * c >= 80 * (len(a) + len(sets[j]) - c):
                    x, y = sorted((find(i), find(j)))
                    root[y] = x
        assert [got.get(i, i) for i in range(len(sets))] == [find(i) for i in range(len(sets))]


def test_empty_table_and_extra_columns(spark, empty_docs):
    assert partenum.jaccard_components(empty_docs).count() == 0
    rows = [(1, "A b\tc d e f", 5, "x"), (2, "a B c\nd e f", 6, "y"), (None, "a b c d e f", 7, "z"), (3, None, 8, None),
            (3, "a b", 1, "q"), (0, "a  b", 2, "r"), (None, "lonely words here", 1, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_shingles long, component_id string")
    assert joined(docs) == sorted([(1, 2, 1), (2, 2, 1), (None, 2, 1), (3, 0, 3), (3, 1, 0), (0, 1, 0), (None, 1, None)], key=str)


def test_very_long_texts_in_one_batch(spark):
    rng = np.random.default_rng(9)
    base = [f"v{x}" for x in rng.integers(0, 3000, 60_000)]
    rows = [(i, " ".join(edited(rng, base, 300 * i, 10**9))) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert joined(docs) == plain_join(rows)


def test_sketches_bound_the_difference_from_below():
    rng = np.random.default_rng(10)
    base = rng.integers(0, 1 << 62, 400)
    sets = [np.unique(np.append(base[rng.random(400) > 0.1], rng.integers(0, 1 << 62, int(rng.integers(0, 60))))) for _ in range(40)]
    sets[3] = sets[3][:0]
    doc = np.repeat(np.arange(40), [len(x) for x in sets])
    rows = parity_sketches(doc, np.concatenate(sets), 40).to_pylist()
    bits = [np.unpackbits(np.array(r, np.int64).view(np.uint8)) for r in rows]
    for i in range(40):
        for j in range(i):
            apart = len(np.setxor1d(sets[i], sets[j]))
            differ = int((bits[i] != bits[j]).sum())
            assert differ <= apart and (apart - differ) % 2 == 0
    assert len(parity_sketches(doc[:0], base[:0], 0)) == 0 and not bits[3].any()


def test_sets_no_pair_names_are_not_sent(spark):
    """However long the list of pairs is, a join on sets drops the others before its
    exchange, and gives the same links."""
    import random
    from specimen.llm import groups
    draw = random.Random(5)
    ids = [draw.getrandbits(64) - 2 ** 63 for _ in range(2000)]
    sets = spark.createDataFrame([(i, list(range(n, n + 20))) for n, i in enumerate(ids)], "id long, items array<long>")
    near = [(ids[n], ids[n + 1 + n % 2 * 9]) for n in range(60)]
    pairs = spark.createDataFrame(near, "a long, b long")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = {r.id for r in groups._only(sets, pairs, "a", "b").collect()}
        got = {(r.a, r.b): r.linked for r in groups.checked(pairs, sets, 80, 100).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    wanted = {i for pair in near for i in pair}
    assert wanted <= left and len(left) <= len(wanted) + 5
    assert got == {pair: n % 2 == 0 for n, pair in enumerate(near)}


def large_sets(n_pairs=12):
    """Sets of 700 to 6,000 items: (2i, 2i + 1) share a part that shrinks with i, others nothing."""
    rng = np.random.default_rng(11)
    sets = []
    for i in range(n_pairs):
        base = rng.choice(1 << 60, int(rng.integers(700, 6000)), replace=False)
        lost = rng.random(len(base)) < (0.02 + 0.04 * i) / 2
        sets += [np.sort(base), np.sort(np.append(base[~lost], rng.choice(1 << 60, int(lost.sum()))))]
    sets += [rng.integers(0, 1 << 60, 300), rng.integers(0, 1 << 60, 0), rng.integers(0, 1 << 60, 1200)]
    doc = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    return sets, doc, np.concatenate(sets), np.array([len(x) for x in sets])


def test_fine_sketches_bound_the_difference_and_halve():
    sets, doc, items, sizes = large_sets()
    fine = fine_sketches(doc, items, sizes).to_pylist()
    plain = parity_sketches(doc, items, len(sets)).to_pylist()
    halves = lambda x, n: x if len(x) == n else halves([a ^ b for a, b in zip(x[:len(x) // 2], x[len(x) // 2:])], n)
    bits = lambda x, y: sum(((a ^ b) & (1 << 64) - 1).bit_count() for a, b in zip(x, y))
    for i, x in enumerate(fine):
        assert (x is None) == (sizes[i] <= 512)
        if x is not None:
            assert 2 * sizes[i] <= 64 * len(x) < 4 * sizes[i] and halves(x, 16) == plain[i]
    for i in range(0, 24, 2):
        n = min(len(fine[i]), len(fine[i + 1]))
        assert bits(halves(fine[i], n), halves(fine[i + 1], n)) <= len(np.setxor1d(sets[i], sets[i + 1]))
    assert fine_sketches(doc[:0], items[:0], sizes[:0]).to_pylist() == []


def test_large_sets_that_cannot_link_are_not_compared_in_full(spark):
    """Sketches of 1,024 bits tell nothing of sets of thousands of items: fine ones end
    pairs of unlike sets before their items are sent, and never one that links."""
    from specimen.llm import groups
    sets, doc, items, sizes = large_sets()
    table = written(spark.createDataFrame(
        list(zip(range(len(sets)), [x.tolist() for x in sets], parity_sketches(doc, items, len(sets)).to_pylist(),
                 fine_sketches(doc, items, sizes).to_pylist())),
        "id long, items array<long>, parity array<long>, fine array<long>"), "test-sets")
    pairs = written(spark.createDataFrame([(i, j) for i in range(len(sets)) for j in range(i)], "a long, b long"), "test-pairs")
    may = {(r.a, r.b): r.may for r in groups.possible(pairs, table, 80, 100).collect()}
    linked = {(r.a, r.b) for r in groups.checked(pairs, table, 80, 100).filter("linked").collect()}
    assert len(may) == len(sets) * (len(sets) - 1) // 2 and None not in may.values()
    passed = {p for p, x in may.items() if x}
    assert linked and linked <= passed
    assert all(a - b == 1 and b % 2 == 0 for a, b in passed), passed - linked


def test_groups_of_the_same_members_are_one(spark):
    from specimen.llm import groups
    rows = [(k, i) for k in range(40) for i in ((1, 2) if k % 2 else (2, 3, 5))] + [(90, 1), (90, 3), (91, 2), (91, 3)]
    members = written(spark.createDataFrame(rows, "key long, id long"), "test-members")
    got = {}
    for r in groups._one_each(members).collect():
        got.setdefault((r.key, r.n), []).append(r.id)
    assert sorted(sorted(x) for x in got.values()) == [[1, 2], [1, 3], [2, 3], [2, 3, 5]]
    assert all(n == len(x) for (_, n), x in got.items())


def test_signatures_cross_the_exchange_in_32_bits():
    """A row holds 32 bits of a signature; with its bucket they are the same of every
    batch, also in the buckets of signatures that several sets share."""
    rng = np.random.default_rng(12)
    sig = np.repeat(rng.integers(-2**63, 2**63 - 1, 500), rng.integers(1, 4, 500))
    node = rng.integers(-2**63, 2**63 - 1, len(sig))
    keys = {}
    for part in (slice(None, None, 2), slice(1, None, 2)):
        batch = partenum._dealt(sig[part], node[part], 24)
        assert str(batch.schema.field("sigs").type.value_type) == "int32"
        for r in batch.to_pylist():
            for n, (s, x) in enumerate(zip(r["sigs"], r["nodes"])):
                home = r["bucket"] if r["homes"] is None else r["homes"][n]
                keys.setdefault((home, s), set()).add(x)
    wanted = {}
    for s, x in zip(sig.tolist(), node.tolist()):
        wanted.setdefault(s, set()).add(x)
    assert sorted(map(sorted, keys.values())) == sorted(map(sorted, wanted.values()))


def test_items_are_made_for_the_sets_that_need_them(spark, monkeypatch):
    """Texts that share a passage are candidates, but only their sketches are written;
    items are made for the sets of pairs that these leave open, and not read without any."""
    rng = np.random.default_rng(13)
    passage = [f"p{x}" for x in range(30)]
    rows = [(i, " ".join([*passage, *(f"w{x}" for x in rng.integers(0, 10**9, 900))])) for i in range(60)]
    rows += [(100, rows[3][1] + " more"), (101, rows[8][1] + " words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    made, plain = {}, partenum.written

    def counted(df, name):
        out = plain(df, name)
        made.setdefault(name, []).append((out.count(), out.columns))
        return out
    monkeypatch.setattr(partenum, "written", counted)
    assert joined(docs) == plain_join(rows)
    assert made["sets"] == [(made["wanted"][0][0], ["id", "size", "parity", "fine"])]
    assert all(columns == ["id", "items"] for _, columns in made["items"])
    assert 4 <= sum(n for n, _ in made["items"]) <= 12, made
