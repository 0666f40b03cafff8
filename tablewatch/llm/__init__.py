"""Operators of a training-data pipeline, each with its registered query."""

from __future__ import annotations

from tablewatch.llm.fingerprints import op10_order_minhash
from tablewatch.llm.language import op7_language_bitmask_filters
from tablewatch.llm.lines import OP5_SQL, op5_line_dedup
from tablewatch.llm.minhash import op9_minhash_near_dedup
from tablewatch.llm.packing import op1_best_fit_packing
from tablewatch.llm.phrases import OP13_SQL, op13_dynamic_phrase_counting
from tablewatch.llm.quality import op3_weak_label_quality
from tablewatch.llm.recompression import op8_recompression_substring_dedup
from tablewatch.llm.sampling import op2_gumbel_segmentations
from tablewatch.llm.sizeaware import OP11_SQL, op11_size_aware_join
from tablewatch.llm.spelling import OP12_SQL, op12_trie_pair_variants
from tablewatch.llm.topk import OP6_SQL, op6_pivot_top_k
from tablewatch.llm.toxicity import op4_subsequence_kernel_toxicity

QUERIES = {
    f.__name__: f
    for f in (
        op1_best_fit_packing,
        op2_gumbel_segmentations,
        op3_weak_label_quality,
        op4_subsequence_kernel_toxicity,
        op5_line_dedup,
        op6_pivot_top_k,
        op7_language_bitmask_filters,
        op8_recompression_substring_dedup,
        op9_minhash_near_dedup,
        op10_order_minhash,
        op11_size_aware_join,
        op12_trie_pair_variants,
        op13_dynamic_phrase_counting,
    )
}

#: DuckDB SQL for those that SQL can express over whole tables.
ORACLE: dict[str, str] = {
    "op5_line_dedup": OP5_SQL,
    "op6_pivot_top_k": OP6_SQL,
    "op11_size_aware_join": OP11_SQL,
    "op12_trie_pair_variants": OP12_SQL,
    "op13_dynamic_phrase_counting": OP13_SQL,
}
