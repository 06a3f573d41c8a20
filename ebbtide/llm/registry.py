"""The queries of this subpackage, by name, and their SQL twins where SQL can say the same."""

from __future__ import annotations

from ebbtide.llm import (
    bit_sliced,
    chat_windows,
    decontaminate,
    imatch,
    language_id,
    lexical_search,
    line_dedup,
    merkle_manifest,
    minhash_forest,
    ngram_filter,
    piece_dropout,
    suffix_dedup,
    token_files,
)

QUERIES = {
    f.__name__: f
    for f in (
        suffix_dedup.op1_suffix_dedup,
        minhash_forest.op2_minhash_forest,
        chat_windows.op3_chat_windows,
        decontaminate.op4_decontaminate,
        piece_dropout.op5_piece_dropout,
        bit_sliced.op6_bit_sliced_top_k,
        token_files.op7_token_files,
        language_id.op8_language_id,
        line_dedup.op9_line_dedup,
        ngram_filter.op10_ngram_filter,
        merkle_manifest.op11_merkle_manifest,
        imatch.op12_imatch,
        lexical_search.op13_lexical_search,
    )
}

ORACLES = {
    "op6_bit_sliced_top_k": bit_sliced.ORACLE_SQL,
    "op9_line_dedup": line_dedup.ORACLE_SQL,
    "op11_merkle_manifest": merkle_manifest.ORACLE_SQL,
    "op12_imatch": imatch.ORACLE_SQL,
    "op13_lexical_search": lexical_search.ORACLE_SQL,
}
