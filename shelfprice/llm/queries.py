"""Queries of the subpackage, and the SQL of those that SQL can express."""

from . import (decontaminate, divergence, embedding_dedup, fingerprints, html_extract, jaccard_join, lexical_search, lm_score, mixing, quality, secrets,
               suffix_dedup, url_filter)

QUERIES = {
    "op1_secrets": secrets.op1_secrets,
    "op2_decontamination": decontaminate.op2_decontamination,
    "op3_jaccard_join": jaccard_join.op3_jaccard_join,
    "op4_url_filter": url_filter.op4_url_filter,
    "op5_html_extract": html_extract.op5_html_extract,
    "op6_fingerprints": fingerprints.op6_fingerprints,
    "op7_lm_score": lm_score.op7_lm_score,
    "op8_suffix_dedup": suffix_dedup.op8_suffix_dedup,
    "op9_quality": quality.op9_quality,
    "op10_mixing": mixing.op10_mixing,
    "op11_divergence": divergence.op11_divergence,
    "op12_search": lexical_search.op12_search,
    "op13_embedding_dedup": embedding_dedup.op13_embedding_dedup,
}

ORACLE_SQL = {
    "op3_jaccard_join": jaccard_join.ORACLE,
    "op4_url_filter": url_filter.ORACLE,
    "op10_mixing": mixing.oracle_sql(),
    "op11_divergence": divergence.ORACLE,
    "op12_search": lexical_search.ORACLE,
    "op13_embedding_dedup": embedding_dedup.ORACLE,
}
