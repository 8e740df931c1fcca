"""The queries of the training-data operators, and their SQL where SQL can express them."""

from . import (bpe, chat, exact_dedup, filter_audit, licenses, merkle, mixing, near_dedup, pieces, repeats, token_files, topk,
               toxicity)

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_repeats": repeats.op2_repeats,
    "op3_bpe": bpe.op3_bpe,
    "op4_licenses": licenses.op4_licenses,
    "op5_near_dedup": near_dedup.op5_near_dedup,
    "op6_exact_dedup": exact_dedup.op6_exact_dedup,
    "op7_chat": chat.op7_chat,
    "op8_mixing": mixing.op8_mixing,
    "op9_topk": topk.op9_topk,
    "op10_token_files": token_files.op10_token_files,
    "op11_merkle": merkle.op11_merkle,
    "op12_sentencepiece": pieces.op12_sentencepiece,
    "op13_filter_audit": filter_audit.op13_filter_audit,
}

ORACLES = {
    "op6_exact_dedup": exact_dedup.ORACLE,
    "op7_chat": chat.ORACLE,
    "op8_mixing": mixing.ORACLE,
    "op9_topk": topk.ORACLE,
    "op11_merkle": merkle.ORACLE,
    "op13_filter_audit": filter_audit.ORACLE,
}
