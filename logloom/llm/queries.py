"""The registered queries of this subpackage, and their DuckDB twins."""

from __future__ import annotations

from logloom.llm import (centroids, chat_format, decontaminate, exact_dedup, hpylm_words, html_extract, importance, line_dedup, mixing, packing, pu_quality,
                         simhash, token_counts)

QUERIES = {
    "op1_html_extract": html_extract.op1_html_extract,
    "op2_exact_dedup": exact_dedup.op2_exact_dedup,
    "op3_hpylm": hpylm_words.op3_hpylm,
    "op4_best_fit_packing": packing.op4_best_fit_packing,
    "op5_decontaminate": decontaminate.op5_decontaminate,
    "op6_chat_format": chat_format.op6_chat_format,
    "op7_pu_quality": pu_quality.op7_pu_quality,
    "op8_line_dedup": line_dedup.op8_line_dedup,
    "op9_simhash": simhash.op9_simhash,
    "op10_token_counts": token_counts.op10_token_counts,
    "op11_centroids": centroids.op11_centroids,
    "op12_importance_resampling": importance.op12_importance_resampling,
    "op13_mixing": mixing.op13_mixing,
}

ORACLE = {
    "op2_exact_dedup": exact_dedup.ORACLE,
    "op6_chat_format": chat_format.ORACLE,
    "op11_centroids": centroids.ORACLE,
    "op13_mixing": mixing.ORACLE,
}
