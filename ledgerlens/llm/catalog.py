"""Registered queries of this subpackage: name -> (plan builder, check SQL or None)."""

from __future__ import annotations

from . import backoff_automaton, cap_filters, cross_align, edit_counts, fill_in_middle, hyperminhash, kdtree_shards, pair_index_bpe, suffix_decontamination, token_blocks, toxicity_cnn, url_markov, warc

QUERIES = {
    "op1_pfor_token_blocks": (token_blocks.op1_pfor_token_blocks, None),
    "op2_kdtree_shards": (kdtree_shards.op2_kdtree_shards, None),
    "op3_hyperminhash": (hyperminhash.op3_hyperminhash, hyperminhash.OP3_SQL),
    "op4_backoff_automaton": (backoff_automaton.op4_backoff_automaton, None),
    "op5_toxicity_cnn": (toxicity_cnn.op5_toxicity_cnn, None),
    "op6_suffix_decontamination": (suffix_decontamination.op6_suffix_decontamination, suffix_decontamination.OP6_SQL),
    "op7_cap_filters": (cap_filters.op7_cap_filters, cap_filters.OP7_SQL),
    "op8_url_markov_ratio": (url_markov.op8_url_markov_ratio, url_markov.OP8_SQL),
    "op9_pair_index_bpe": (pair_index_bpe.op9_pair_index_bpe, None),
    "op10_edit_counts": (edit_counts.op10_edit_counts, None),
    "op11_fenwick_fim": (fill_in_middle.op11_fenwick_fim, fill_in_middle.OP11_SQL),
    "op12_shared_cut_alignment": (cross_align.op12_shared_cut_alignment, None),
    "op13_warc_transactions": (warc.op13_warc_transactions, warc.OP13_SQL),
}
