"""Registered queries of this package and their DuckDB SQL."""

from daystream.llm import (align_tokens, class_lm, embed_dedup, html_extract, line_dedup, mix, near_dup, pack, quality, resample,
                           substring_dedup, suffix_dedup, toxicity)

QUERIES = {
    "op1_suffix_dedup": suffix_dedup.op1_suffix_dedup,
    "op2_class_lm": class_lm.op2_class_lm,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_pack": pack.op4_pack,
    "op5_mix": mix.op5_mix,
    "op6_near_duplicates": near_dup.op6_near_duplicates,
    "op7_extract": html_extract.op7_extract,
    "op8_embedding_duplicates": embed_dedup.op8_embedding_duplicates,
    "op9_quality": quality.op9_quality,
    "op10_substring_dedup": substring_dedup.op10_substring_dedup,
    "op11_resample": resample.op11_resample,
    "op12_line_dedup": line_dedup.op12_line_dedup,
    "op13_align": align_tokens.op13_align,
}

ORACLE_SQL = {
    "op1_suffix_dedup": suffix_dedup.OP1_SQL,
    "op5_mix": mix.OP5_SQL,
    "op8_embedding_duplicates": embed_dedup.OP8_SQL,
    "op10_substring_dedup": substring_dedup.OP10_SQL,
    "op11_resample": resample.OP11_SQL,
    "op12_line_dedup": line_dedup.OP12_SQL,
}
