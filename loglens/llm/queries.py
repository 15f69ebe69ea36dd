"""The registered queries of this package, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from . import ann, bpe, chat, decontaminate, lm, mixing, negatives, pages, quality, resample, sharding, simhash, toxicity

QUERIES = {
    "op1_byte_bpe": bpe.query,
    "op2_quality_rules": quality.query,
    "op3_mix": mixing.query,
    "op4_simhash": simhash.query,
    "op5_shards": sharding.query,
    "op6_toxicity": toxicity.query,
    "op7_chat_rotation": chat.query,
    "op8_permutation_index": ann.query,
    "op9_page_text": pages.query,
    "op10_lm_score": lm.query,
    "op11_resample": resample.query,
    "op12_decontaminate": decontaminate.query,
    "op13_hard_negatives": negatives.query,
}

ORACLES: dict[str, str] = {"op3_mix": mixing.SQL, "op7_chat_rotation": chat.SQL, "op11_resample": resample.SQL, "op12_decontaminate": decontaminate.SQL, "op13_hard_negatives": negatives.SQL}
