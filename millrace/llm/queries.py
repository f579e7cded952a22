"""The registered queries of the subpackage and their SQL twins."""

from __future__ import annotations

from millrace.llm import byte_pairs, decontaminate, lexical_search, licenses, line_dedup, quality, simhash, source_mix, spelling, substring_dedup, token_counts, toxicity, url_filter

QUERIES = {
    "op1_license_scan": licenses.query,
    "op2_line_dedup": line_dedup.query,
    "op3_quality_rules": quality.query,
    "op4_simhash": simhash.query,
    "op5_decontaminate": decontaminate.query,
    "op6_token_counts": token_counts.query,
    "op7_substring_dedup": substring_dedup.query,
    "op8_source_mix": source_mix.query,
    "op9_url_filter": url_filter.query,
    "op10_toxicity": toxicity.query,
    "op11_spelling_variants": spelling.query,
    "op12_byte_bpe": byte_pairs.query,
    "op13_lexical_search": lexical_search.query,
}
ORACLES = {
    "op1_license_scan": licenses.ORACLE,
    "op8_source_mix": source_mix.ORACLE,
    "op9_url_filter": url_filter.ORACLE,
    "op11_spelling_variants": spelling.ORACLE,
    "op13_lexical_search": lexical_search.ORACLE,
}
