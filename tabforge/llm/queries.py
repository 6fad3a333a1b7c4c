"""The numbered queries and their SQL twins."""

from __future__ import annotations

from tabforge.llm import collocations, context_tree, exact_dedup, fingerprints, line_dedup, mixing, near_dedup, packing, periodic_runs, pii_surrogates, quality_classifier, quality_rules, url_filters

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_pii_surrogates": pii_surrogates.op2_pii_surrogates,
    "op3_pack_mixture": packing.op3_pack_mixture,
    "op4_exact_dedup": exact_dedup.op4_exact_dedup,
    "op5_url_filter": url_filters.op5_url_filter,
    "op6_context_tree": context_tree.op6_context_tree,
    "op7_mix_sources": mixing.op7_mix_sources,
    "op8_quality_rules": quality_rules.op8_quality_rules,
    "op9_quality_classifier": quality_classifier.op9_quality_classifier,
    "op10_near_dedup": near_dedup.op10_near_dedup,
    "op11_periodic_runs": periodic_runs.op11_periodic_runs,
    "op12_fingerprints": fingerprints.op12_fingerprints,
    "op13_collocations": collocations.op13_collocations,
}

ORACLE_SQL = {
    "op1_line_dedup": line_dedup.OP1_SQL,
    "op4_exact_dedup": exact_dedup.OP4_SQL,
    "op5_url_filter": url_filters.OP5_SQL,
    "op7_mix_sources": mixing.OP7_SQL,
    "op8_quality_rules": quality_rules.OP8_SQL,
    "op13_collocations": collocations.OP13_SQL,
}
