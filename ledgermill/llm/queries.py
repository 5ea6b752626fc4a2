"""The registered queries of this package and their comparison SQL."""

from __future__ import annotations

from ledgermill.llm import (bpe, exact, html_paths, kd_shards, kneser_ney, language, lexical, mixing, quality, repair, simhash,
                            transducer, urls)

QUERIES = {
    "op5_quality_rules": quality.query,
    "op7_url_filters": urls.query,
    "op1_html_extraction": html_paths.query,
    "op6_source_mixing": mixing.query,
    "op3_language_id": language.query,
    "op10_kneser_ney": kneser_ney.query,
    "op2_simhash_near_dedup": simhash.query,
    "op4_byte_bpe": bpe.query,
    "op8_token_counts": transducer.query,
    "op9_exact_dedup": exact.query,
    "op11_kd_shards": kd_shards.query,
    "op12_lexical_search": lexical.query,
    "op13_conversation_repair": repair.query,
}

ORACLES = {
    "op6_source_mixing": mixing.ORACLE,
    "op9_exact_dedup": exact.ORACLE,
    "op12_lexical_search": lexical.ORACLE,
}
