"""The queries of this subpackage and, where SQL can express them, their DuckDB SQL.

Most of them write the steps before the last as tables in the shared folder
(or fit a model) while they are built, so building one runs its jobs, also
where only its plan is asked for. Those tables stay until
``spark.checkpoint.dir`` is cleared.
"""

from __future__ import annotations

from kpimart.llm.ann import op3_neighbours
from kpimart.llm.chat import OP7_SQL, op7_chat
from kpimart.llm.dedup import op2_minhash
from kpimart.llm.fingerprints import op1_fingerprints
from kpimart.llm.hard_negatives import OP12_SQL, op12_hard_negatives
from kpimart.llm.mixing import op8_mix
from kpimart.llm.packing import op4_pack
from kpimart.llm.phrases import OP13_SQL, op13_phrases
from kpimart.llm.pii import op6_pii
from kpimart.llm.quality import op5_quality
from kpimart.llm.token_counts import op11_token_counts
from kpimart.llm.token_files import op10_token_files
from kpimart.llm.toxicity import op9_toxicity

QUERIES = {
    "op1_fingerprints": op1_fingerprints,
    "op2_minhash": op2_minhash,
    "op3_neighbours": op3_neighbours,
    "op4_pack": op4_pack,
    "op5_quality": op5_quality,
    "op6_pii": op6_pii,
    "op7_chat": op7_chat,
    "op8_mix": op8_mix,
    "op9_toxicity": op9_toxicity,
    "op10_token_files": op10_token_files,
    "op11_token_counts": op11_token_counts,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_phrases": op13_phrases,
}

ORACLE_SQL: dict[str, str] = {"op7_chat": OP7_SQL, "op12_hard_negatives": OP12_SQL, "op13_phrases": OP13_SQL}
