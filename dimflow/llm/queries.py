"""Queries of the numbered operators and their SQL twins."""

from dimflow.llm import (
    hard_negatives, language, neighbours, ngram_join, packing, quality, secrets, sentencepieces, suffix_dedup, token_counts, toxicity,
    url_filter, vector_codes,
)

QUERIES = {
    f.__name__: f
    for f in (
        quality.op1_quality_rules, secrets.op2_secret_scans, language.op3_language_id, suffix_dedup.op4_suffix_array_dedup,
        token_counts.op5_token_counts, url_filter.op6_url_filters, packing.op7_best_fit_packing,
        ngram_join.op8_ngram_jaccard, sentencepieces.op9_sentencepiece, neighbours.op10_nearest_neighbours,
        toxicity.op11_toxicity, vector_codes.op12_vector_codes, hard_negatives.op13_hard_negatives,
    )
}
ORACLE = {
    "op1_quality_rules": quality.SQL, "op6_url_filters": url_filter.SQL,
    "op12_vector_codes": vector_codes.SQL, "op13_hard_negatives": hard_negatives.SQL,
}
