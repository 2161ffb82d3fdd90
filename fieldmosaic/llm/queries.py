"""The registered queries of this subpackage and, where SQL can express them, their DuckDB SQL."""

from . import audit, contamination, exact, language, lm, personal, pieces, quality, repeats, sharding, simhash, trie, warc

QUERIES = {
    "op1_pieces": pieces.op1_pieces,
    "op2_repeats": repeats.op2_repeats,
    "op3_personal": personal.op3_personal,
    "op4_language": language.op4_language,
    "op5_suffix_tree": lm.op5_suffix_tree,
    "op6_warc": warc.op6_warc,
    "op7_contamination": contamination.op7_contamination,
    "op8_simhash": simhash.op8_simhash,
    "op9_exact": exact.op9_exact,
    "op10_quality": quality.op10_quality,
    "op11_filter_audit": audit.op11_filter_audit,
    "op12_prefix_trie": trie.op12_prefix_trie,
    "op13_hash_tree": sharding.op13_hash_tree,
}

ORACLE_SQL: dict[str, str] = {
    "op7_contamination": contamination.OP7_SQL,
    "op9_exact": exact.OP9_SQL,
    "op11_filter_audit": audit.OP11_SQL,
    "op12_prefix_trie": trie.OP12_SQL,
    "op13_hash_tree": sharding.OP13_SQL,
}
