"""The pipeline's stages on their own inputs and as a whole."""

from __future__ import annotations

from collections import Counter, defaultdict

import corpus_pipeline
from specimen.llm.common import written


def test_stages(spark, edge_docs, small_docs, empty_docs):
    for docs in (edge_docs, small_docs, empty_docs):
        rows, at = docs, docs.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = written(stage(spark, rows, ""), f"test-{name}")
            assert out.columns == at, name
            before, after = rows.count(), out.count()
            assert after >= before if name == "mixing" else after <= before
            if name == "line_dedup":
                assert after == before
                assert all(r.n_chars == len(r.text) for r in out.collect())
            rows = out
        pieces = corpus_pipeline.STAGES[-1][1](spark, rows, "").collect()
        total = Counter()
        for p in pieces:
            total[p.doc_id] += p.length
        ids = {r.doc_id for r in rows.collect()}
        assert set(total) == ids


def test_run(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    spans = defaultdict(list)
    for r in out:
        spans[r.sequence_id].append((r.offset, r.length))
    for v in spans.values():
        at = 0
        for o, n in sorted(v):
            assert o == at
            at += n
        assert at <= 1024
