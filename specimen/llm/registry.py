"""The queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from specimen.llm.infill import OP11_SQL, op11_infill
from specimen.llm.langid import op10_language_id
from specimen.llm.line_dedup import OP1_SQL, op1_line_dedup
from specimen.llm.minhash_dedup import op8_near_dedup
from specimen.llm.mixing import OP6_SQL, op6_mixing
from specimen.llm.packing import op5_packing
from specimen.llm.partenum import op12_ngram_join
from specimen.llm.periodic import op13_periodic_runs
from specimen.llm.pii import op7_pii
from specimen.llm.quality import op4_quality_rules
from specimen.llm.token_counts import op3_token_counts
from specimen.llm.toxicity import op2_toxicity
from specimen.llm.winnow import op9_fingerprints

QUERIES = {f.__name__: f for f in (
    op1_line_dedup, op2_toxicity, op3_token_counts, op4_quality_rules, op5_packing, op6_mixing,
    op7_pii, op8_near_dedup, op9_fingerprints, op10_language_id, op11_infill,
    op12_ngram_join, op13_periodic_runs)}

ORACLES = {"op1_line_dedup": OP1_SQL, "op6_mixing": OP6_SQL, "op11_infill": OP11_SQL}
