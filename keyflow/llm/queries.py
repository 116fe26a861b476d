"""Queries of the ``llm`` operators and, where SQL can express them, their oracles."""

from __future__ import annotations

from keyflow.llm import bpe, chat, langid, lm, media, mixing, near, quality, substrings, vectors

QUERIES = {
    "op1_embedding_near_dedup": vectors.op1,
    "op2_media_columns": media.op2,
    "op3_lm_scoring": lm.op3,
    "op4_jaccard_join": near.op4,
    "op5_chat_formatting": chat.op5,
    "op6_bpe_codec": bpe.op6,
    "op7_substring_dedup": substrings.op7,
    "op8_language_id": langid.op8,
    "op9_quality_classifier": quality.op9,
    "op10_source_mixing": mixing.op10,
}

ORACLES = {
    "op1_embedding_near_dedup": vectors.ORACLE,
    "op4_jaccard_join": near.ORACLE,
    "op5_chat_formatting": chat.ORACLE,
    "op7_substring_dedup": substrings.ORACLE,
    "op10_source_mixing": mixing.ORACLE,
}
