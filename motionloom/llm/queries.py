"""The training-data queries and their SQL."""

from __future__ import annotations

from motionloom.llm import bpe, exact_dedup, langid, mixing, packing, quality, resampling, search, simhash, suffix_dedup, token_files, topk, warc


def queries() -> dict:
    return {
        "op1_language_id": langid.op1_language_id,
        "op2_warc": warc.op2_warc,
        "op3_bpe_encode_decode": bpe.op3_bpe_encode_decode,
        "op4_exact_topk": topk.op4_exact_topk,
        "op5_exact_dedup": exact_dedup.op5_exact_dedup,
        "op6_simhash_near_dedup": simhash.op6_simhash_near_dedup,
        "op7_token_files": token_files.op7_token_files,
        "op8_suffix_dedup": suffix_dedup.op8_suffix_dedup,
        "op9_quality_classifier": quality.op9_quality_classifier,
        "op10_packing": packing.op10_packing,
        "op11_mixing": mixing.op11_mixing,
        "op12_ranked_search": search.op12_ranked_search,
        "op13_importance_resampling": resampling.op13_importance_resampling,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_warc": warc.SQL, "op4_exact_topk": topk.SQL, "op5_exact_dedup": exact_dedup.SQL, "op11_mixing": mixing.SQL, "op12_ranked_search": search.SQL}
