"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from folio.llm import licenses, mixing, near_copies, pu_quality, repeats, token_file, topk, url_filter, vector_graph, word_bpe

QUERIES = {
    "op1_rans": token_file.op1_rans,
    "op2_pu_quality": pu_quality.op2_pu_quality,
    "op3_lsh_forest": near_copies.op3_lsh_forest,
    "op4_url_vocabulary": url_filter.op4_url_vocabulary,
    "op5_word_bpe": word_bpe.op5_word_bpe,
    "op6_vector_graph": vector_graph.op6_vector_graph,
    "op7_mixing": mixing.op7_mixing,
    "op8_maxscore": topk.op8_maxscore,
    "op9_suffix_array": repeats.op9_suffix_array,
    "op10_license_classifier": licenses.op10_license_classifier,
}

ORACLE_SQL = {
    "op6_vector_graph": vector_graph.ORACLE,
    "op3_lsh_forest": near_copies.ORACLE,
    "op4_url_vocabulary": url_filter.ORACLE,
    "op7_mixing": mixing.ORACLE,
    "op8_maxscore": topk.ORACLE,
    "op10_license_classifier": licenses.oracle(),
}
