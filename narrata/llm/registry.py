"""Queries of the training-data operators and, where SQL can say the same, their SQL."""

from __future__ import annotations

import corpus_pipeline
from narrata.llm import exact_dedup, html, language, licenses, line_dedup, minhash, mixing, neighbours, packing, periodic, quality, resampling, token_counts


def queries() -> dict:
    return {
        "op1_quality": quality.op1_quality,
        "op2_packing": packing.op2_packing,
        "op3_html": html.op3_html,
        "op4_minhash": minhash.op4_minhash,
        "op5_mixing": mixing.op5_mixing,
        "op6_exact_dedup": exact_dedup.op6_exact_dedup,
        "op7_licenses": licenses.op7_licenses,
        "op8_line_dedup": line_dedup.op8_line_dedup,
        "op9_language": language.op9_language,
        "op10_embedding_dedup": neighbours.op10_embedding_dedup,
        "op11_resampling": resampling.op11_resampling,
        "op12_periodic": periodic.op12_periodic,
        "op13_token_counts": token_counts.op13_token_counts,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {"op4_minhash": minhash.SQL, "op6_exact_dedup": exact_dedup.SQL, "op8_line_dedup": line_dedup.SQL, "op10_embedding_dedup": neighbours.SQL, "op11_resampling": resampling.SQL}
