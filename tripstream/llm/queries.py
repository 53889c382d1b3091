"""The operators of this package as queries over the driver's tables, and their SQL."""

from __future__ import annotations

from tripstream.llm import (
    ann, bpe, chat, exact_dedup, importance, language_id, line_dedup, packing, repair, sentence_pieces, simhash, suffix_array,
    token_counts,
)


def queries() -> dict:
    return {
        "op1_ann": ann.op1_ann,
        "op2_chat": chat.op2_chat,
        "op3_exact_dedup": exact_dedup.op3_exact_dedup,
        "op4_line_dedup": line_dedup.op4_line_dedup,
        "op5_simhash": simhash.op5_simhash,
        "op6_packing": packing.op6_packing,
        "op7_language_id": language_id.op7_language_id,
        "op8_suffix_array": suffix_array.op8_suffix_array,
        "op9_bpe": bpe.op9_bpe,
        "op10_token_counts": token_counts.op10_token_counts,
        "op11_repair": repair.op11_repair,
        "op12_importance": importance.op12_importance,
        "op13_sentencepiece": sentence_pieces.op13_sentencepiece,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_chat": chat.OP2_SQL,
        "op3_exact_dedup": exact_dedup.OP3_SQL,
        "op4_line_dedup": line_dedup.OP4_SQL,
        "op11_repair": repair.OP11_SQL,
        "op12_importance": importance.OP12_SQL,
    }
