"""The registered queries of this subpackage, and the SQL they must equal where SQL can say it."""

from claimlens.llm import alignment, bpe, decontaminate, html_extract, kdtree_topk, lang_id, license_scan, phrases, quality_fm, rank_queue, simhash, suffix_dedup, token_counts

QUERIES = {
    "op1_main_text": html_extract.op1_main_text,
    "op2_licenses": license_scan.op2_licenses,
    "op3_quality": quality_fm.op3_quality,
    "op4_top_k": kdtree_topk.op4_top_k,
    "op5_suffix_dedup": suffix_dedup.op5_suffix_dedup,
    "op6_decontamination": decontaminate.op6_decontamination,
    "op7_token_counts": token_counts.op7_token_counts,
    "op8_bpe": bpe.op8_bpe,
    "op9_language": lang_id.op9_language,
    "op10_simhash": simhash.op10_simhash,
    "op11_alignment": alignment.op11_alignment,
    "op12_rank_queue_bpe": rank_queue.op12_rank_queue_bpe,
    "op13_phrases": phrases.op13_phrases,
}
ORACLE: dict[str, str] = {
    "op2_licenses": license_scan.OP2_SQL,
    "op4_top_k": kdtree_topk.OP4_SQL,
    "op6_decontamination": decontaminate.OP6_SQL,
    "op13_phrases": phrases.OP13_SQL,
}
