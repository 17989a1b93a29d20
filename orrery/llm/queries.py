"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from . import chat, decontaminate, jaccard_join, language_id, lattice_lm, merkle, mixing, secrets, substring_dedup, topk, url_filter, warc, whitening

QUERIES = {
    "op1_language_id": language_id.op1_language_id,
    "op2_mix_sources": mixing.op2_mix_sources,
    "op3_secrets": secrets.op3_secrets,
    "op4_top_k": topk.op4_top_k,
    "op5_jaccard_join": jaccard_join.op5_jaccard_join,
    "op6_url_filter": url_filter.op6_url_filter,
    "op7_warc": warc.op7_warc,
    "op8_decontaminate": decontaminate.op8_decontaminate,
    "op9_chat_format": chat.op9_chat_format,
    "op10_substring_dedup": substring_dedup.op10_substring_dedup,
    "op11_merkle_manifest": merkle.op11_merkle_manifest,
    "op12_lattice_lm": lattice_lm.op12_lattice_lm,
    "op13_whitening": whitening.op13_whitening,
}

ORACLE_SQL = {
    "op4_top_k": topk.ORACLE_SQL,
    "op5_jaccard_join": jaccard_join.ORACLE_SQL,
    "op6_url_filter": url_filter.ORACLE_SQL,
    "op8_decontaminate": decontaminate.ORACLE_SQL,
    "op9_chat_format": chat.ORACLE_SQL,
    "op10_substring_dedup": substring_dedup.ORACLE_SQL,
    "op11_merkle_manifest": merkle.ORACLE_SQL,
}
