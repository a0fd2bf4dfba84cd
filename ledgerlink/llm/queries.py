"""Registered queries of the corpus operators, one per operator."""

from __future__ import annotations

from ledgerlink.llm import decontaminate, katz, main_text, mixing, multi_index, near_dup, personal_data, piece_codec, pivot_codes, secret_scan, toxicity, turn_repair
from ledgerlink.llm.token_file import op1_token_files

QUERIES = {
    "op1_token_files": op1_token_files,
    "op2_mixing": mixing.op2_mixing,
    "op3_decontaminate": decontaminate.op3_decontaminate,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_nearest_vectors": multi_index.op5_nearest_vectors,
    "op6_personal_data": personal_data.op6_personal_data,
    "op7_secrets": secret_scan.op7_secrets,
    "op8_main_text": main_text.op8_main_text,
    "op9_katz": katz.op9_katz,
    "op10_near_duplicates": near_dup.op10_near_duplicates,
    "op11_piece_codec": piece_codec.op11_piece_codec,
    "op12_vector_codes": pivot_codes.op12_vector_codes,
    "op13_turn_repair": turn_repair.op13_turn_repair,
}

ORACLES: dict[str, str] = {
    "op3_decontaminate": decontaminate.ORACLE,
    "op6_personal_data": personal_data.ORACLE,
    "op7_secrets": secret_scan.ORACLE,
    "op10_near_duplicates": near_dup.ORACLE,
    "op12_vector_codes": pivot_codes.ORACLE,
    "op13_turn_repair": turn_repair.ORACLE,
}
