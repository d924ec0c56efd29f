"""The subpackage's queries and their SQL, added to the library's by ``__spark_entry__``."""

from __future__ import annotations

from peerscope.llm import (
    ann, bpe, hard_negatives, kdtree, line_dedup, minhash_dedup, packing, sequence_packing, sharding, substring_dedup, toxicity, url_filter,
    vector_codes,
)

QUERIES = {
    "op1_bpe": bpe.op1_bpe,
    "op2_url_filter": url_filter.op2_url_filter,
    "op3_substring_dedup": substring_dedup.op3_substring_dedup,
    "op4_line_dedup": line_dedup.op4_line_dedup,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_packing": packing.op6_packing,
    "op7_ann": ann.op7_ann,
    "op8_topk": kdtree.op8_topk,
    "op9_near_dedup": minhash_dedup.op9_near_dedup,
    "op10_sharding": sharding.op10_sharding,
    "op11_vector_codes": vector_codes.op11_vector_codes,
    "op12_hard_negatives": hard_negatives.op12_hard_negatives,
    "op13_sequence_packing": sequence_packing.op13_sequence_packing,
}

ORACLE_SQL = {
    "op3_substring_dedup": substring_dedup.SQL,
    "op4_line_dedup": line_dedup.SQL,
    "op8_topk": kdtree.SQL,
    "op9_near_dedup": minhash_dedup.SQL,
    "op11_vector_codes": vector_codes.SQL,
    "op12_hard_negatives": hard_negatives.SQL,
}
