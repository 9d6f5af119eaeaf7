"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from vitalspark.llm import block_search, bpe, chat, kneser_ney, language_id, manifest, merkle, mixing, periodic_runs, quality_cnn, set_join, token_file, wordpiece_count

QUERIES = {
    "op1_merkle_fingerprint": merkle.op1_merkle_fingerprint,
    "op2_huffman_tokens": token_file.op2_huffman_tokens,
    "op3_chat_format": chat.op3_chat_format,
    "op4_bpe_round_trip": bpe.op4_bpe_round_trip,
    "op5_kneser_ney": kneser_ney.op5_kneser_ney,
    "op6_mix_sources": mixing.op6_mix_sources,
    "op7_block_search": block_search.op7_block_search,
    "op8_wordpiece_count": wordpiece_count.op8_wordpiece_count,
    "op9_shingle_join": set_join.op9_shingle_join,
    "op10_quality_cnn": quality_cnn.op10_quality_cnn,
    "op11_dataset_manifest": manifest.op11_dataset_manifest,
    "op12_periodic_runs": periodic_runs.op12_periodic_runs,
    "op13_language_id": language_id.op13_language_id,
}

ORACLE = {
    "op3_chat_format": chat.ORACLE_SQL,
    "op7_block_search": block_search.ORACLE_SQL,
    "op9_shingle_join": set_join.ORACLE_SQL,
    "op11_dataset_manifest": manifest.ORACLE_SQL,
}
