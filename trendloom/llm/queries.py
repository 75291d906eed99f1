"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from . import (
    chat, collocations, hnsw, impact, lattice, minhash, mixing, packing, pseudonyms, repair, secrets, substrings,
    toxicity,
)
from . import sql as S

QUERIES = {
    "op1_chat_format": chat.op1_chat_format,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_pfair_mix": mixing.op3_pfair_mix,
    "op4_secret_crf": secrets.op4_secret_crf,
    "op5_length_buckets": packing.op5_length_buckets,
    "op6_hnsw_near_dup": hnsw.op6_hnsw_near_dup,
    "op7_minhash_odd_sketch": minhash.op7_minhash_odd_sketch,
    "op8_impact_topk": impact.op8_impact_topk,
    "op9_feistel_pseudonyms": pseudonyms.op9_feistel_pseudonyms,
    "op10_subword_lattice": lattice.op10_subword_lattice,
    "op11_fm_collocations": collocations.op11_fm_collocations,
    "op12_conversation_repair": repair.op12_conversation_repair,
    "op13_substring_dedup": substrings.op13_substring_dedup,
}
ORACLES = {
    "op1_chat_format": S.OP1,
    "op3_pfair_mix": S.op3_sql(),
    "op5_length_buckets": S.op5_sql(),
    "op8_impact_topk": S.OP8,
    "op11_fm_collocations": S.OP11,
    "op12_conversation_repair": S.OP12,
    "op13_substring_dedup": S.OP13,
}
