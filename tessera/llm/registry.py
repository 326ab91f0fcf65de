"""Queries of the operators and their SQL, for the driver contract."""

from __future__ import annotations

from tessera.llm import (
    collocations, decontaminate, jaccard, mixing, packing, prefixtrie, rules, secrets, suffixtree, templates, tokens,
    topk, toxicity,
)

QUERIES = {
    "op1_quality_rules": rules.query,
    "op2_jaccard_join": jaccard.query,
    "op3_template_removal": templates.query,
    "op4_secret_scans": secrets.query,
    "op5_suffix_tree_lm": suffixtree.query,
    "op6_source_mix": mixing.query,
    "op7_decontaminate": decontaminate.query,
    "op8_toxicity": toxicity.query,
    "op9_token_counts": tokens.query,
    "op10_exact_topk": topk.query,
    "op11_collocations": collocations.query,
    "op12_packing": packing.query,
    "op13_prefix_trie": prefixtrie.query,
}
# The others train models, search or parse, which SQL does not express; they
# are tested against brute force or held-out rows.
SQL = {
    "op6_source_mix": mixing.ORACLE_SQL,
    "op10_exact_topk": topk.ORACLE_SQL,
    "op11_collocations": collocations.ORACLE_SQL,
    "op13_prefix_trie": prefixtrie.ORACLE_SQL,
}
