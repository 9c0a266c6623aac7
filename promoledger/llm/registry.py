"""The queries of this package and their SQL, by name."""

from __future__ import annotations

from promoledger.llm import bpe, conversation_trie, decontamination, forest, html_text, langid, line_dedup, multi_index, packing, quality, resampling, simhash, warc

QUERIES = {
    "op1_line_dedup": line_dedup.query,
    "op2_quality_classifier": quality.query,
    "op3_warc": warc.query,
    "op4_simhash_near_dedup": simhash.query,
    "op5_language_id": langid.query,
    "op6_embedding_near_dedup": forest.query,
    "op7_nearest_neighbours": multi_index.query,
    "op8_packing": packing.query,
    "op9_bpe_encode_decode": bpe.query,
    "op10_html_extraction": html_text.query,
    "op11_decontamination": decontamination.query,
    "op12_importance_resampling": resampling.query,
    "op13_conversation_trie": conversation_trie.query,
}
SQL: dict[str, str] = {
    "op1_line_dedup": line_dedup.SQL,
    "op3_warc": warc.SQL,
    "op8_packing": packing.SQL,
    "op11_decontamination": decontamination.SQL,
    "op13_conversation_trie": conversation_trie.SQL,
}
