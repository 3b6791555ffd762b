"""The registered queries of the operators in this folder, and their SQL."""

from __future__ import annotations

from linktide.llm.conversations import OP12_SQL, op12_conversation_repair
from linktide.llm.decontaminate import OP5_SQL, op5_benchmark_decontamination
from linktide.llm.importance import OP13_SQL, op13_importance_resampling
from linktide.llm.mixing import OP6_SQL, op6_mix_sources
from linktide.llm.near_dedup import op8_minhash_near_dedup
from linktide.llm.pii import op7_personal_data
from linktide.llm.quality import op1_quality_classifier
from linktide.llm.rules import OP3_SQL, op3_quality_rules
from linktide.llm.secrets import op10_secret_scan
from linktide.llm.suffix_dedup import op4_suffix_dedup
from linktide.llm.token_counts import op9_token_counts
from linktide.llm.token_output import op2_token_files
from linktide.llm.toxicity import op11_toxicity

QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_token_files": op2_token_files,
    "op3_quality_rules": op3_quality_rules,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_mix_sources": op6_mix_sources,
    "op7_personal_data": op7_personal_data,
    "op8_minhash_near_dedup": op8_minhash_near_dedup,
    "op9_token_counts": op9_token_counts,
    "op10_secret_scan": op10_secret_scan,
    "op11_toxicity": op11_toxicity,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_importance_resampling": op13_importance_resampling,
}

ORACLE_SQL = {
    "op3_quality_rules": OP3_SQL,
    "op5_benchmark_decontamination": OP5_SQL,
    "op6_mix_sources": OP6_SQL,
    "op12_conversation_repair": OP12_SQL,
    "op13_importance_resampling": OP13_SQL,
}
