"""The operators on the given tables: name -> (callable, SQL or None)."""

from __future__ import annotations

from panelwright.llm import bpe, chat, fingerprint, html_text, licenses, mixing, personal, phrases, resample, simhash, token_counts, topk, toxicity

QUERIES = {
    "op1_mixing_rates": (mixing.query, None),
    "op2_simhash_near_dedup": (simhash.query, None),
    "op3_chat_windows": (chat.query, None),
    "op4_toxicity": (toxicity.query, None),
    "op5_exact_top_k": (topk.query, topk.SQL),
    "op6_token_counts": (token_counts.query, None),
    "op7_html_wrapper_text": (html_text.query, None),
    "op8_bpe_round_trip": (bpe.query, None),
    "op9_improbable_features": (fingerprint.query, None),
    "op10_license_digests": (licenses.query, licenses.SQL),
    "op11_phrase_collocations": (phrases.query, phrases.SQL),
    "op12_personal_data": (personal.query, None),
    "op13_target_resampling": (resample.query, None),
}
