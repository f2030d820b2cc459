"""The queries of this subpackage and their checking SQL."""

from __future__ import annotations

from tidemark.llm.cotraining import op6_quality_cotraining
from tidemark.llm.decontaminate import op10_benchmark_decontamination
from tidemark.llm.language import op7_language_id
from tidemark.llm.manifest import OP13_SQL, op13_merkle_manifest
from tidemark.llm.merkle import op4_document_fingerprints
from tidemark.llm.ngram_join import OP5_SQL, op5_ngram_jaccard_join
from tidemark.llm.recurrent_lm import op3_lm_scoring
from tidemark.llm.template_html import op2_html_extraction
from tidemark.llm.token_codec import op9_token_ids
from tidemark.llm.token_mix import op8_mix_to_target
from tidemark.llm.toxicity import op12_toxicity
from tidemark.llm.turn_repair import OP11_SQL, op11_turn_repair
from tidemark.llm.url_filter import OP1_SQL, op1_url_filters

QUERIES = {
    "op1_url_filters": op1_url_filters,
    "op2_html_extraction": op2_html_extraction,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_document_fingerprints": op4_document_fingerprints,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_quality_cotraining": op6_quality_cotraining,
    "op7_language_id": op7_language_id,
    "op8_mix_to_target": op8_mix_to_target,
    "op9_token_ids": op9_token_ids,
    "op10_benchmark_decontamination": op10_benchmark_decontamination,
    "op11_turn_repair": op11_turn_repair,
    "op12_toxicity": op12_toxicity,
    "op13_merkle_manifest": op13_merkle_manifest,
}
ORACLES = {
    "op1_url_filters": OP1_SQL,
    "op5_ngram_jaccard_join": OP5_SQL,
    "op11_turn_repair": OP11_SQL,
    "op13_merkle_manifest": OP13_SQL,
}
