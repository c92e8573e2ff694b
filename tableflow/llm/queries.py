"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from tableflow.llm import (
    chat,
    collocations,
    exact_dedup,
    html,
    lm_scoring,
    mixing,
    packing,
    prefix_trie,
    quality_classifier,
    quality_rules,
    simhash,
    token_store,
    winnow,
)

QUERIES = {
    "op1_quality_rules": quality_rules.op1_quality_rules,
    "op2_html_extract": html.op2_html_extract,
    "op3_mixing": mixing.op3_mixing,
    "op4_winnowing": winnow.op4_winnowing,
    "op5_chat_format": chat.op5_chat_format,
    "op6_quality_classifier": quality_classifier.op6_quality_classifier,
    "op7_simhash": simhash.op7_simhash,
    "op8_best_fit_packing": packing.op8_best_fit_packing,
    "op9_token_store": token_store.op9_token_store,
    "op10_lm_scoring": lm_scoring.op10_lm_scoring,
    "op11_prefix_trie": prefix_trie.op11_prefix_trie,
    "op12_exact_dedup": exact_dedup.op12_exact_dedup,
    "op13_collocations": collocations.op13_collocations,
}

ORACLES = {
    "op1_quality_rules": quality_rules.OP1_SQL,
    "op3_mixing": mixing.OP3_SQL,
    "op11_prefix_trie": prefix_trie.OP11_SQL,
    "op12_exact_dedup": exact_dedup.OP12_SQL,
    "op13_collocations": collocations.OP13_SQL,
}
