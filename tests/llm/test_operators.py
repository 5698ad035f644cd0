"""Every operator against a plain Python version, and on the edge rows."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from specimen.llm import langid, line_dedup, minhash_dedup, mixing, packing, pii, quality, token_counts, toxicity, winnow
from specimen.llm import tokens as tok

WS = " \t\n\x0b\x0c\r"


def rows_of(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]


# ---------------------------------------------------------------- 1 line dedup

def plain_line_dedup(rows):
    holders = defaultdict(set)
    key = lambda s: "".join(c.lower() if "A" <= c <= "Z" else c for c in s.strip(WS))
    at = lambda d: -(1 << 63) if d is None else d
    for d, t in rows:
        for s in (t or "").split("\n"):
            if len(key(s)) >= 20:
                holders[key(s)].add(at(d))
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [s for s in lines if len(holders[key(s)]) < 3 or max(holders[key(s)]) == at(d)]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("which", ["edge_docs", "small_docs"])
def test_line_dedup(which, request):
    docs = request.getfixturevalue(which)
    out = line_dedup.dedup_report(docs)
    got = [(r.doc_id, r.n, r.k or 0, r._ld_kept) for r in out.select(
        "doc_id", F.size("_ld_lines").alias("n"), F.when(F.col("_ld_drop").isNotNull(), F.size("_ld_drop")).alias("k"),
        "_ld_kept").collect()]
    assert sorted(got, key=str) == plain_line_dedup(rows_of(docs, "doc_id", "text"))
    cleaned = line_dedup.dedup_lines(docs)
    assert cleaned.columns == docs.columns and cleaned.count() == docs.count()


# ---------------------------------------------------------------- 2 toxicity

def test_chain_marginals_by_enumeration():
    rng = np.random.default_rng(3)
    scores, trans = rng.normal(size=7), np.exp(rng.normal(size=(2, 2)))
    lengths = np.array([4, 0, 3])
    got = toxicity.marginals(scores, lengths, trans)
    want, at = [], 0
    for n in lengths:
        s = scores[at:at + n]
        at += n
        total, per = 0.0, np.zeros(n)
        for m in range(2 ** n):
            y = [(m >> i) & 1 for i in range(n)]
            w = math.exp(sum(s[i] * y[i] for i in range(n))) * math.prod(trans[a, b] for a, b in zip(y, y[1:]))
            total += w
            per += w * np.array(y)
        want += list(per / total if n else [])
    assert np.allclose(got, want)


def test_toxicity_learns_words_and_stems(spark):
    rng = np.random.default_rng(5)
    clean = ["".join(rng.choice(list("abcdeilnorstu"), 6)) for _ in range(400)]
    rows, labels = [], []
    for i in range(400):
        words = list(rng.choice(clean, 40))
        bad = i % 2
        if bad:
            for k in rng.choice(40, 3, replace=False):
                words[k] = "vileword" if i % 4 == 1 else "gruxa" + str(rng.choice(clean))
        rows.append((i, " ".join(words)))
        labels.append((i, bad))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    out = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(out[i].score >= 0.5) == bool(i % 2) for i in held]) >= 0.95
    spans = [rows[i][1][s.start:s.end] for i in held for s in out[i].spans]
    assert spans and np.mean([w == "vileword" or w.startswith("gruxa") for w in spans]) > 0.95


def test_toxicity_edges(spark, edge_docs, empty_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (99, 1), (None, 0), (5, None)], "doc_id long, toxic int")
    model = toxicity.fit(edge_docs, labels)
    got = toxicity.score(edge_docs, model).collect()
    assert len(got) == edge_docs.count() and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score(empty_docs, None).count() == 0
    assert toxicity.fit(empty_docs, labels.limit(0)) is None


# ---------------------------------------------------------------- 3 token counts and 5 packing

def json_ids(text):
    return tok._json_encoder(tok.default_paths()[0]).encode(text, add_special_tokens=False).ids


def test_encoder_equals_tokenizer():
    encode = tok.encoder()
    texts = ["", " ", "  a", "a  b", "x \n y", "a\n b", "don't  stop", "naïve café — 12 345", "<|endoftext|> a", "\t\x1c z",
             "a b", "一二三 日本", "end ", " lead", "tab\t tab", "a" * 3000]
    for t in texts:
        assert np.frombuffer(encode(t), "<u4").tolist() == json_ids(t), repr(t)


def test_edits_equal_full_encoding():
    rng = np.random.default_rng(1)
    alphabet = list("ab cd\n é 1,.") + ["  ", " the", "ing ", "\t"]
    encode = tok.chunk_encoder()
    for _ in range(60):
        text = "".join(rng.choice(alphabet, int(rng.integers(0, 400))))
        tree = token_counts.Tree.build(text, encode, leaf=3)
        assert tree.total == len(json_ids(text))
        for _ in range(4):
            a, b = sorted(rng.integers(0, len(text) + 1, 2).tolist())
            b = min(b, a + 12)
            new = "".join(rng.choice(alphabet, int(rng.integers(0, 8))))
            want = text[:a] + new + text[b:]
            text, _ = tree.edit(text, a, b, new, encode)
            assert text == want and tree.total == len(json_ids(text))
            assert tree.chars.sum() == len(text)


def test_token_counts_edges(edge_docs, empty_docs):
    counted = token_counts.count_tokens(edge_docs).withColumn("edits", token_counts.sample_edits(F.col("text")))
    out = token_counts.apply_edits(counted).collect()
    assert len(out) == edge_docs.count()
    for r in out:
        assert r.n_tokens == len(json_ids(r.text))
    assert token_counts.apply_edits(token_counts.count_tokens(empty_docs).withColumn(
        "edits", token_counts.sample_edits(F.col("text")))).count() == 0
    assert token_counts.clipped([{"start": 5, "end": 99, "text": None}, {"start": 3, "end": 7, "text": "z"}, None], 10) == [
        (7, 10, ""), (3, 7, "z")]


@pytest.mark.parametrize("which", ["edge_docs", "small_docs", "empty_docs"])
def test_packing_round_trip(which, request):
    docs = request.getfixturevalue(which)
    pieces = packing.pack(docs).collect()
    want = Counter(tuple(json_ids(t or "") + [0]) for _, t in rows_of(docs, "doc_id", "text"))
    by_seq, total, padded = defaultdict(list), 0, 0
    for p in pieces:
        assert len(p.ids) == 4 * p.length > 0
        by_seq[p.sequence_id].append(p)
    for ps in by_seq.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 1024
        total, padded = total + at, padded + (0 if at & (at - 1) == 0 else 1024 - at)
    assert total == sum(len(k) * n for k, n in want.items())
    if which == "small_docs":
        assert padded < 0.02 * total + 3 * 1024
        docs_ids = defaultdict(list)
        for p in sorted(pieces, key=lambda p: p.start):
            docs_ids[p.doc_id] += np.frombuffer(p.ids, "<u4").tolist()
        assert Counter(map(tuple, docs_ids.values())) == want


def test_cut_plan():
    for r in range(1, 1024):
        plan = packing.cut_plan(r)
        assert sum(n for n, _ in plan) == r and all(n <= 1024 // j for n, j in plan)


# ---------------------------------------------------------------- 4 quality

def plain_metrics(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [s for s in text.split("\n") if s.strip(WS)]
    seen = defaultdict(list)
    for i in range(len(w) - 7):
        seen[tuple(w[i:i + 8])].append(i)
    covered = {p for at in seen.values() if len(at) > 1 for i in at for p in range(i, i + 8)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


@pytest.mark.parametrize("which", ["edge_docs", "small_docs", "empty_docs"])
def test_base_metrics(which, request):
    docs = request.getfixturevalue(which)
    cols = ("_q_n", "_q_chars", "_q_symbols", "_q_dup", "_q_repeat")
    got = [(r.text or "", tuple(r[c] for c in cols)) for r in quality.base_metrics(docs).select("text", *cols).collect()]
    assert [m for _, m in got] == [plain_metrics(t) for t, _ in got]


def test_quality_scores(spark, small_docs, edge_docs, empty_docs):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    trusted = labels.filter("quality = 1").select("doc_id").distinct()
    table = quality.weights(quality.gram_counts(small_docs, trusted))
    assert len(table) == quality.BUCKETS
    hashed = quality._with_hashes(small_docs).select("doc_id", quality._grams(quality.BUCKETS).alias("g")).collect()
    good = {r.doc_id for r in trusted.collect()}
    raw, target = Counter(), Counter()
    for r in hashed:
        raw.update(r.g)
        if r.doc_id in good:
            target.update(r.g)
    n, m = sum(raw.values()) + quality.BUCKETS, sum(target.values()) + quality.BUCKETS
    for b in list(raw)[:200]:
        assert table[b] == round(1000 * (math.log((target[b] + 1) / m) - math.log((raw[b] + 1) / n)))
    scores = {r.doc_id: r._q_score for r in quality.scored(small_docs, table).select("doc_id", "_q_score").collect()}
    for r in hashed:
        assert scores[r.doc_id] == pytest.approx(np.mean([table[b] for b in r.g]) if r.g else None)
    out = quality.judge(edge_docs, labels)
    assert out.count() == edge_docs.count() and out.filter("n_words < 20 and kept").count() == 0
    assert quality.judge(empty_docs, labels).count() == 0


# ---------------------------------------------------------------- 6 mixing

def test_mixing_realises_weights(spark):
    rows = [(i, "big" if i % 4 else "small", "w " * (1 + i % 7)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(5)
    size = Counter()
    for _, s, t in rows:
        size[s] += len(t.split())
    out = mixing.mix(docs, max_repeats=1.5).collect()
    got, per_doc = Counter(), Counter()
    for r in out:
        got[r.source] += r._mx_tokens
        per_doc[r.doc_id] += 1
    assert set(per_doc) == {i for i, _, _ in rows} and max(per_doc.values()) == 2
    assert got["big"] == size["big"]
    assert size["small"] * 1.5 - 7 <= got["small"] <= size["small"] * 1.5
    # the second block holds the first documents of its permutation
    order = sorted((hashlib.md5(f"mix:2:{i}:{hashlib.md5(t.encode()).hexdigest()}".encode()).hexdigest(), i)
                   for i, s, t in rows if s == "small")
    twice = {i for i, n in per_doc.items() if n == 2}
    assert {i for _, i in order[:len(twice)]} == twice


def test_mixing_meets_quotas_without_ids(spark):
    """A third of the rows without id, a sixth under one id: the cut is within a document."""
    rows = [(None if i % 3 == 0 else 7 if i % 6 == 1 else i, "big" if i % 4 else "small", f"t{i} " + "w " * (i % 9))
            for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(7)
    out = mixing.mix(docs, max_repeats=1.5)
    got = {r.source: r.n for r in out.groupBy("source").agg(F.sum("_mx_tokens").alias("n")).collect()}
    quota = {r.source: r.quota for r in mixing.plan(docs, max_repeats=1.5).collect()}
    assert set(got) == set(quota) and all(quota[s] - 9 <= got[s] <= quota[s] for s in quota)


def test_mixing_exponent_and_edges(spark, edge_docs, empty_docs):
    docs = spark.createDataFrame([(i, f"s{i % 5}", "w " * (10 ** (i % 5) // 7 + 1)) for i in range(10)],
                                 "doc_id long, source string, text string")
    sizes = mixing.source_sizes(docs)
    t = np.array([r.tokens for r in sizes.collect()], float)
    alpha = mixing.bisect_exponent(sizes, target_entropy=0.8, max_repeats=None)
    p = t ** alpha / (t ** alpha).sum()
    assert -(p * np.log(p)).sum() == pytest.approx(0.8 * np.log(5), abs=1e-4)
    beta = mixing.bisect_exponent(sizes, max_repeats=3.0)
    assert (t.max() / t.min()) ** (1 - beta) == pytest.approx(3.0, rel=1e-4)
    out = mixing.mixed_rows(edge_docs)
    assert out.columns == edge_docs.columns and out.count() >= edge_docs.count()
    assert set(rows_of(out, "doc_id", "text")) == set(rows_of(edge_docs, "doc_id", "text"))
    assert mixing.mixed_rows(empty_docs).count() == 0
    few = mixing.mix(docs, max_repeats=None, budget=20)
    assert few.agg(F.sum("_mx_tokens")).first()[0] <= 20


# ---------------------------------------------------------------- 7 personal data

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(s):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(s))) % 10 == 0


def plain_base(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m[0].split("."))
                    or kind == "card" and 13 <= len(digits) <= 19 and luhn(digits)
                    or kind == "phone" and 9 <= len(digits) <= 15):
                out.append((pii.KINDS.index(kind), m.start(), m.end()))
    return out


TRICKY = ["a@b.c_x@d.e f@@g.h i@j. k.l@m-n.o.p", "1.2.3.4.5.6.7.8 999.1.1.1 0001.002.3.255 1.2.3.256", "4111 1111 1111 1111, 4111-1111-1111-1112 12",
          "+1 (555) 555-0100 x +49.30.123 45 678 +1", "é 4111111111111111é@x.y", "+1 +1 +1 555 555 5555", "", "x" * 5000 + "@", "9" * 4000,
          " ".join(f"u{i}@h.io" for i in range(700))]


def test_base_spans(spark, edge_docs, small_docs, empty_docs):
    rng = np.random.default_rng(2)
    noise = ["".join(rng.choice(list("19 .@+-(a_%é"), 60)) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(TRICKY + noise)), "doc_id long, text string")
    for d in (docs, edge_docs, small_docs, empty_docs):
        texts = Counter((k, tuple(plain_base(t or ""))) for k, t in rows_of(d, "doc_id", "text"))
        found = pii.find_base(d).select(F.when(F.col("id") != pii._NULL_ID, F.col("id")).alias("doc_id"), "found").collect()
        assert Counter((r.doc_id, tuple((x.kind, x.start, x.end) for x in r.found if x.kind < 4)) for r in found) == texts


def test_patterns_discover(spark):
    rows = [(i, f"some text contact u{i}@mail.example.org thanks for that {i}") for i in range(40)]
    rows += [(100 + i, f"other words contact ID{i:07d}XK thanks again") for i in range(5)]
    rows += [(200 + i, f"lot number batch{i:09d} was sold") for i in range(5)]
    out = {r.doc_id: r for r in pii.detect(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i in range(5):
        assert [rows[40 + i][1][s.start:s.end] for s in out[100 + i].added] == [f"ID{i:07d}XK"]
        assert out[200 + i].added is None
    assert all(len(out[i].base) == 1 for i in range(40))


def test_patterns_of_discovered_instances(spark):
    rows = [(i, f"some text contact u{i}@mail.example.org thanks") for i in range(60)]
    rows += [(100 + i, f"words contact ID{i:07d}XK closing") for i in range(20)]
    rows += [(200 + i, f"elsewhere QZ{i:07d}AB closing") for i in range(2)]  # two hops from an e-mail
    rows += [(300 + i, f"account{'abc'[i % 3]} mail=v{i}@mail.example.org end") for i in range(40)]
    rows += [(400 + i, f"a new mail=USR{i:07d} came") for i in range(5)]
    rows += [(500 + i, f'{{"mail":"w{i}@mail.example.org"}}') for i in range(20)]
    rows += [(600 + i, f'so {{"mail":"KEY{i:07d}"}}') for i in range(4)]
    rows += [(700 + i, f"lot number batch{i:09d} was sold") for i in range(5)]
    text = dict(rows)
    got = {r.doc_id: [text[r.doc_id][s.start:s.end] for s in r.added or []]
           for r in pii.detect(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[200 + i] == [f"QZ{i:07d}AB"] for i in range(2))
    assert all(got[400 + i] == [f"USR{i:07d}"] for i in range(5))
    assert all(got[600 + i] == [f"KEY{i:07d}"] for i in range(4))
    assert all(got[100 + i] == [f"ID{i:07d}XK"] for i in range(20)) and not any(got[700 + i] for i in range(5))


def test_keys_rejected_numbers_and_lists(spark):
    """Keys before opaque strings are learned; numbers that fail a rule are never added and
    count against their patterns; contexts are whole words and reach along lists."""
    long = "z" * 300
    rows = [(i, f"blah token = \"{hashlib.sha1(str(i).encode()).hexdigest()}\" bl{i}") for i in range(6)]
    rows += [(100 + i, f"set token=\"Pw{i:06d}x\" here{i}") for i in range(3)]     # the key, not the form
    rows += [(150, 'a token = "Qx12345y"### b')]                                    # ends at the quote
    rows += [(200 + i, f"commit {hashlib.sha1(str(-i).encode()).hexdigest()} n{i}") for i in range(6)]
    rows += [(300 + i, f"pay 4111111111111111 o{i}") for i in range(4)]
    rows += [(400 + i, f"pay 41111111111111{12 + i} p{i}") for i in range(3)]         # fails Luhn
    rows += [(500 + i, f"{long}a u{i}@h.io e{i}") for i in range(5)] + [(600, f"{long}a CODE0001234 f"), (601, f"{long}b CODE0009999 g")]
    rows += [(700 + i, f"mailing a{i}@h.io b{i}@h.io c{i}@h.io q{i}") for i in range(2)] + [(710, "mailing USER0004321 w")]
    text = dict(rows)
    got = {r.doc_id: [text[r.doc_id][s.start:s.end] for s in r.added or []]
           for r in pii.detect(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i] == [hashlib.sha1(str(i).encode()).hexdigest()] for i in range(6))
    assert all(got[100 + i] == [f"Pw{i:06d}x"] for i in range(3))
    assert got[150] == ["Qx12345y"]
    assert not any(got[200 + i] for i in range(6)) and not any(got[400 + i] for i in range(3))
    assert got[600] == ["CODE0001234"] and not got[601] and got[710] == ["USER0004321"]


def plain_scores(rows, rounds):
    """Scores of patterns by dictionaries: rows of (instance, type, patterns)."""
    kind, edges = {}, set()
    for instance, t, patterns in rows:
        if patterns:
            kind[instance] = min(t, kind.get(instance, t))
        edges |= {(p, instance) for p in patterns}
    of, conf, scores = dict(kind), {i: 1000 if t <= pii.OPAQUE else 0 for i, t in kind.items()}, {}
    for _ in range(rounds):
        scores = {}
        for p in {p for p, _ in edges}:
            mine = [i for q, i in edges if q == p]
            s, m, t = max((sum(conf[i] for i in mine if of[i] == t), sum(conf[i] >= pii.FLOOR for i in mine if of[i] == t), t)
                          for t in {of[i] for i in mine})
            if m >= pii.MIN_SEEDS and (t != pii.OPAQUE or p.endswith("=")):
                scores[p] = (t, s // (len(mine) + 1))
        for i, t in kind.items():
            if t > pii.OPAQUE:
                mine = [scores[p] for p, j in edges if j == i and p in scores]
                mean = sum(s for _, s in mine) // len(mine) if mine else 0
                of[i] = max((s, k) for k, s in mine)[1] if mine else t
                conf[i] = mean if t == pii.FREE and mean >= pii.FLOOR else 0
    return scores


def test_pattern_scores_by_brute_force(spark):
    rng = np.random.default_rng(5)
    words = [f"{side} w{j}{'=' * (j % 3 == 0)}" for side in "LR" for j in range(6)]
    types = [int(rng.choice([0, 1, 2, 3, pii.OPAQUE, pii.FREE, pii.FREE, pii.REJECTED])) for _ in range(60)]
    rows = [(i, types[i], [str(w) for w in rng.choice(words, int(rng.integers(0, 4)), replace=False)])
            for i in rng.integers(0, 60, 200).tolist()]
    occurrences = spark.createDataFrame(rows, "instance long, type int, patterns array<string>")
    for rounds in (1, 3):
        got = {r.pattern: (r.of, r.score) for r in pii.score_patterns(occurrences, rounds).collect()}
        assert got == plain_scores(rows, rounds) and got


# ---------------------------------------------------------------- 8 near duplicates

def plain_classes(rows, threshold=0.8):
    bags = []
    for _, t in rows:
        w = (t or "").lower().split()
        bags.append(Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))))
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    at = lambda i: minhash_dedup._NULL_ID if rows[i][0] is None else rows[i][0]
    for i in range(len(rows)):
        for j in range(i):
            if at(i) == at(j) or sum((bags[i] & bags[j]).values()) >= threshold * sum((bags[i] | bags[j]).values()):
                a, b = sorted((root(i), root(j)), key=at)
                parent[b] = a
    return sorted((rows[i][0], at(root(i))) for i in range(len(rows)) if rows[i][0] is not None)


def test_darts_estimate_weighted_similarity():
    rng = np.random.default_rng(4)
    a, b = rng.integers(0, 9, 300), rng.integers(0, 9, 300)
    b[:220] = a[:220]
    el = minhash_dedup._mix(np.arange(300, dtype=np.uint64))
    text = np.repeat([0, 1], [np.count_nonzero(a), np.count_nonzero(b)])
    sig = minhash_dedup.signatures(text, np.concatenate([el[a > 0], el[b > 0]]), np.concatenate([a[a > 0], b[b > 0]]), 2, 4096)
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert (sig != 0).all() and (sig[0] == sig[1]).mean() == pytest.approx(want, abs=0.03)


def test_near_duplicates(spark, small_docs, empty_docs):
    rng = np.random.default_rng(6)
    base = [str(w) for w in rng.integers(0, 10_000, 120)]
    rows = rows_of(small_docs, "doc_id", "text")
    for k in range(60):  # a large group of near copies, chained further and further away
        w = list(base)
        for i in range(k // 3):
            w[(7 * i) % 120] = f"v{i}"
        rows.append((100_000 + k, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(rows_of(minhash_dedup.near_duplicates(docs), "doc_id", "class_id"))
    assert got == plain_classes(rows)
    kept = minhash_dedup.keep_first(docs)
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in got})
    assert minhash_dedup.near_duplicates(empty_docs).count() == 0


def test_near_duplicate_edges(edge_docs):
    found = minhash_dedup.near_duplicates(edge_docs)
    assert found.count() == edge_docs.count()
    cls = {r.doc_id: r.class_id for r in found.collect() if r.doc_id is not None}
    assert cls[1] == cls[2] == cls[15] == minhash_dedup._NULL_ID  # with the null id's row
    assert cls[3] == cls[5] == 3 and len({cls[k] for k in (8, 9, 10, 12, 13)}) == 5
    kept = minhash_dedup.keep_first(edge_docs)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == edge_docs.columns and len(ids) == len(set(ids))


@pytest.mark.parametrize("n", range(6))
def test_blocks_of_few_words(n):
    import pyarrow as pa
    few, long = " ".join("abcde"[:n]), "x y z " * 70_000
    for texts in ([few], [few, long], [long, few], [None] * 255 + [long, few]):
        batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["id", "text"])
        signed = pa.Table.from_batches(minhash_dedup._sign([batch])).to_pydict()
        sets = pa.Table.from_batches(minhash_dedup._expand([batch])).to_pydict()
        assert signed["id"] == sets["id"] == list(range(len(texts)))
        at = texts.index(few)
        alone, = minhash_dedup._expand([pa.RecordBatch.from_arrays(
            [pa.array([0, 1]), pa.array([few, "p q r s t u"])], names=["id", "text"])])
        assert signed["weight"][at] == len(sets["items"][at]) == min(n, 1)
        assert sets["items"][at] == alone.column(1)[0].as_py()


def test_null_and_repeated_ids_keep_their_texts(spark):
    rng = np.random.default_rng(8)
    words = lambda: [str(w) for w in rng.integers(0, 10_000, 60)]
    five, nine, own = words(), words(), [words() for _ in range(12)]
    rows = [(5, " ".join(five)), (9, " ".join(nine)), (None, " ".join(five + ["x"])), (None, " ".join(nine + ["x"]))]
    rows += [(None, " ".join(w)) for w in own[:6]] * 2 + [(7, " ".join(w)) for w in own[6:]] + [(7, " ".join(own[11]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    kept = rows_of(minhash_dedup.keep_first(docs), "doc_id", "text")
    # one row of every text: no class joins 5 and 9, none of the null or repeated rows is lost
    assert Counter(kept) == Counter({(None, " ".join(five + ["x"])): 1, (None, " ".join(nine + ["x"])): 1,
                                     **{(None, " ".join(w)): 1 for w in own[:6]}, **{(7, " ".join(w)): 1 for w in own[6:]}})
    found = minhash_dedup.near_duplicates(docs).collect()
    assert len(found) == len(rows) and sum(r.kept for r in found) == len({r.class_key for r in found}) == 14
    key = {r.doc_id: r.class_key for r in found}
    assert key[5] != key[9]


# ---------------------------------------------------------------- 9 fingerprints

def test_winnowing(spark, edge_docs, small_docs):
    for docs in (small_docs, edge_docs):
        out = winnow.fingerprints(docs, "text", "fp")
        out = out.withColumn("_w", F.transform(winnow.words(F.lower(F.coalesce("text", F.lit("")))), lambda w: F.xxhash64(w)))
        for r in out.select("_w", "fp_hashes", "fp_at").limit(60).collect():
            n = len(r._w)
            assert bool(n) == bool(r.fp_at) and r.fp_at == sorted(set(r.fp_at)) and len(r.fp_at) == len(r.fp_hashes)
            grams = max(n - 3, 1)
            if grams >= 16:  # every window holds a kept position
                assert r.fp_at[0] < 16 and r.fp_at[-1] >= grams - 16
                assert all(b - a <= 16 for a, b in zip(r.fp_at, r.fp_at[1:]))


def test_winnow_ties_take_the_rightmost(spark):
    docs = spark.createDataFrame([(1, "a " * 60), (2, "a b c")], "doc_id long, text string")
    got = {r.doc_id: r.fp_at for r in winnow.fingerprints(docs, "text", "fp").collect()}
    assert got[1] == list(range(15, 57)) and got[2] == [0]


def test_next_document(spark, edge_docs, empty_docs):
    rows = rows_of(edge_docs, "doc_id", "text")
    at = lambda d: winnow._NULL_ID if d is None else d
    ids = sorted({at(d) for d, _ in rows}, reverse=True)
    need = {i: max(len(t or "") // 2 for d, t in rows if at(d) == i) for i in ids}
    want = Counter()
    for d, t in rows:
        t = t or ""
        nxt = ids[(ids.index(at(d)) + 1) % len(ids)]
        front = min(((u or "")[:need[at(d)]] for e, u in rows if at(e) == nxt))
        h = len(t) // 2
        want[(d, len(t), t[:len(t) - h] + front[:h])] += 1
    assert Counter(rows_of(winnow.with_next(edge_docs), "doc_id", "n_chars", "edited")) == want
    assert winnow.with_next(empty_docs).count() == 0
    one = winnow.with_next(spark.createDataFrame([(5, "abcd")], "doc_id long, text string")).first()
    assert one.edited == "abab"


# ---------------------------------------------------------------- 10 language

def test_language_id(small_docs, edge_docs, empty_docs):
    model = langid.fit(langid.training_rows(small_docs))
    got = {r.doc_id: r.lang_pred for r in langid.predict(small_docs, model).collect()}
    held = [(d, v) for d, v in rows_of(small_docs, "doc_id", "lang") if zlib.crc32(str(d).encode()) % 3 == 1]
    assert np.mean([got[d] == v for d, v in held]) >= 0.95
    edges = {(r.doc_id, r.lang_pred == "und", r.rejected) for r in langid.predict(edge_docs, model).collect()}
    assert {(3, True, True), (4, True, True), (5, True, True), (11, True, True)} <= edges
    kept = langid.keep_identified(edge_docs, model)
    assert kept.columns == edge_docs.columns and {3, 5, 11}.isdisjoint(r.doc_id for r in kept.collect())
    assert langid.predict(empty_docs, langid.fit(empty_docs)).count() == 0


def test_every_length_has_a_floor(spark, small_docs):
    model = langid.fit(langid.training_rows(small_docs))
    rng = np.random.default_rng(3)
    scripts = {"cyrillic": "абвгдежзиклмнопрстуфхцчшщыэюя   ", "cjk": "".join(map(chr, range(0x4e00, 0x9000)))}
    rows = [(f"{k} {n}", "".join(rng.choice(list(letters), n))) for k, letters in scripts.items()
            for n in (8, 12, 40, 1_000, 60_000, 1_000_000)]
    texts = [t for t, in rows_of(small_docs, "text") if t and len(t) > 300]
    own = [(f"own {n}", t[:n]) for t in texts for n in (8, 16, 200)] + [("own 1000000", (" ".join(texts) * 50)[:1_000_000])]
    got = rows_of(langid.predict(spark.createDataFrame(rows + own, "doc_id string, text string"), model), "doc_id", "rejected")
    assert all(rejected for d, rejected in got if not d.startswith("own"))
    assert np.mean([rejected for d, rejected in got if d.startswith("own")]) <= 0.01
    sparse = langid._floors({3: np.eye(1000, dtype=np.int64)[100], 9: 50 * np.eye(1000, dtype=np.int64)[400]})
    assert sparse == {3: 0.05, 9: 0.2} and langid.Model([], None, None, sparse).floor(20) == 0.2


def test_fit_samples_are_bounded_under_hot_ids(spark):
    rows = [(None, f"text number {i} of rows without an id", "en") for i in range(3_000)]
    rows += [(i, "the same copied text", "en") for i in range(3_000)] + [(i, f"texte {i}", "fr") for i in range(20)]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    got = Counter(rows_of(langid._sample(train, 100), "lang", "text"))
    assert max(got.values()) == 1  # distinct texts
    assert Counter(lang for lang, _ in got) == {"en": 100, "fr": 20}
    assert Counter(rows_of(langid._sample(train.repartition(7), 100), "lang", "text")) == got
    docs = spark.createDataFrame([(1, f"hot {i}") for i in range(500)] + [(2, "two"), (3, "three")], "doc_id long, text string")
    chosen = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    assert sorted(rows_of(toxicity._labelled(docs, chosen), "doc_id", "text", "toxic")) == [(1, "hot 0", 1), (2, "two", 0)]


def test_very_long_text_features():
    import pyarrow as pa
    word = "abcdefg hij "
    (_, x), = langid.features(pa.array([word * 200_000]))
    (_, y), = langid.features(pa.array([word * 1_000]))
    assert np.allclose(x / x.sum(), y / y.sum(), atol=1e-3)


def test_a_text_is_encoded_in_one_call(monkeypatch):
    """Rare words do not cost a call each, and odd white space next to a space is
    found wherever it stands."""
    calls = []

    class Counted:
        def encode_ordinary(self, text):
            calls.append(text)
            return [1]
    monkeypatch.setattr(tok, "_rank_encoder", lambda path: Counted())
    encode = tok.encoder()
    text = " ".join(f"rare{k}word" for k in range(500))
    assert encode(text) == b"\x01\0\0\0" and calls == [text]
    for odd in ("a  b", "a \nb", "a\n b", "a\u00a0 b", "a \x1cb", "  a", "a  ", "\t a", "x<|y"):
        assert encode(odd) == np.array(json_ids(odd), "<u4").tobytes()
    assert calls == [text]


def test_language_fit_holds_one_language_at_a_time(spark):
    """The driver's Python never holds the vectors of all fitted texts at once."""
    import random
    import tracemalloc
    draw, rows = random.Random(3), []
    for n in range(1000):
        letters = ("abcde", "fghij", "klmno", "pqrst")[n % 4]
        rows.append((n, " ".join("".join(draw.choices(letters, k=5)) for _ in range(30)), f"l{n % 4}"))
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    tracemalloc.start()
    try:
        model = langid.fit(train)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sorted(set(model.langs)) == ["l0", "l1", "l2", "l3"]
    assert peak < 1000 * langid.DIM * 4
