"""Queries and DuckDB oracles of the operators in this folder."""

from __future__ import annotations

from . import (bpe, conversation_repair, exact_dedup, fingerprints, html_text, language_id, mixing, ngram_join,
               sharding, substring_dedup, token_alignment, url_filter, warc)

QUERIES = {f.__name__: f for f in (
    sharding.op1_sharding,
    bpe.op2_bpe,
    html_text.op3_html_text,
    exact_dedup.op4_exact_dedup,
    fingerprints.op5_fingerprints,
    warc.op6_warc,
    mixing.op7_mixing,
    ngram_join.op8_ngram_join,
    url_filter.op9_url_filter,
    language_id.op10_language_id,
    substring_dedup.op11_substring_dedup,
    conversation_repair.op12_conversation_repair,
    token_alignment.op13_token_alignment,
)}

ORACLES = {
    "op1_sharding": sharding.ORACLE_SQL,
    "op4_exact_dedup": exact_dedup.ORACLE_SQL,
    "op6_warc": warc.ORACLE_SQL,
    "op9_url_filter": url_filter.ORACLE_SQL,
}
