"""Operators for training data, each registered as one query over a provided table."""

from civiframe.llm import (
    op01_language_id,
    op02_toxicity,
    op03_suffix_dedup,
    op04_simhash,
    op05_mixing,
    op06_lines,
    op07_embeddings,
    op08_licenses,
    op09_packing,
    op10_topk,
    op11_lexical_search,
    op12_spelling,
    op13_token_counts,
)

QUERIES = {
    f.__name__: f
    for f in (
        op01_language_id.op1_language_id,
        op02_toxicity.op2_toxicity,
        op03_suffix_dedup.op3_suffix_dedup,
        op04_simhash.op4_simhash_near_dedup,
        op05_mixing.op5_source_mixing,
        op06_lines.op6_line_dedup,
        op07_embeddings.op7_embedding_near_dedup,
        op08_licenses.op8_license_scan,
        op09_packing.op9_packing,
        op10_topk.op10_topk_search,
        op11_lexical_search.op11_lexical_search,
        op12_spelling.op12_spelling_variants,
        op13_token_counts.op13_token_counts,
    )
}
#: SQL for the queries that it can express.
ORACLE: dict[str, str] = {
    "op7_embedding_near_dedup": op07_embeddings.SQL,
    "op10_topk_search": op10_topk.SQL,
    "op11_lexical_search": op11_lexical_search.SQL,
}
