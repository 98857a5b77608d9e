"""Registered queries of this package."""

from __future__ import annotations

from tidemark.llm import alignment, classifier, lines, minhash, mixing, packing, pages, pivotcodes, rules, sharding, substrings, topk, vectors

QUERIES = {
    "op1_cross_polytope_neighbors": vectors.vectors_query,
    "op2_sum_of_squares_packing": packing.pack_query,
    "op3_line_suffix_array": lines.line_query,
    "op4_hamming_minhash": minhash.minhash_query,
    "op5_page_templates": pages.pages_query,
    "op6_byte_shards": sharding.byte_shards_query,
    "op7_de_bruijn_substrings": substrings.substring_query,
    "op8_subword_classifier": classifier.classify_query,
    "op9_decision_list": rules.rules_query,
    "op10_low_discrepancy_mix": mixing.mix_query,
    "op11_shared_cuts": alignment.align_query,
    "op12_laesa_codes": pivotcodes.codes_query,
    "op13_histogram_top_k": topk.top_query,
}

SQL = {
    "op1_cross_polytope_neighbors": vectors.VECTORS_SQL,
    "op3_line_suffix_array": lines.LINE_SQL,
    "op4_hamming_minhash": minhash.MINHASH_SQL,
    "op7_de_bruijn_substrings": substrings.SUBSTRING_SQL,
    "op10_low_discrepancy_mix": mixing.MIX_SQL,
    "op12_laesa_codes": pivotcodes.CODES_SQL,
    "op13_histogram_top_k": topk.TOP_SQL,
}
