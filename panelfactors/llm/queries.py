"""Registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

from . import hard_negatives, phrase_graph, url_rules
from .bpe_codec import op7_bpe
from .hard_negatives import op11_hard_negatives
from .ngram_join import op2_ngram_jaccard_join
from .order_minhash import op5_document_fingerprints
from .phrase_graph import op13_phrases
from .pii import op1_pii
from .ppm_langid import op9_language_id
from .prefix_bpe import op12_byte_bpe
from .quality_rules import op3_quality_rules
from .secret_scan import op4_secret_scans
from .source_mix import op6_source_mix
from .suffix_dedup import op8_suffix_dedup
from .url_rules import op10_url_filters

LLM_QUERIES = {
    "op1_pii": op1_pii,
    "op2_ngram_jaccard_join": op2_ngram_jaccard_join,
    "op3_quality_rules": op3_quality_rules,
    "op4_secret_scans": op4_secret_scans,
    "op5_document_fingerprints": op5_document_fingerprints,
    "op6_source_mix": op6_source_mix,
    "op7_bpe": op7_bpe,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_language_id": op9_language_id,
    "op10_url_filters": op10_url_filters,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_phrases": op13_phrases,
}

#: queries that SQL can express; the others are tested against brute force
LLM_SQL = {
    "op10_url_filters": url_rules.SQL,
    "op11_hard_negatives": hard_negatives.SQL,
    "op13_phrases": phrase_graph.SQL,
}
