"""The registered queries of the corpus operators: one thin ``opN_<name>`` each."""

from __future__ import annotations

from . import conversations, credentials, licenses, lm, minhash, mixing, packing, quality, simhash, tokens, topk, urls, whitening

QUERIES = {
    "op1_quality": quality.op1_quality,
    "op2_lm_score": lm.op2_lm_score,
    "op3_simhash": simhash.op3_simhash,
    "op4_secrets": credentials.op4_secrets,
    "op5_fingerprints": minhash.op5_fingerprints,
    "op6_mix": mixing.op6_mix,
    "op7_top_k": topk.op7_top_k,
    "op8_pack": packing.op8_pack,
    "op9_token_counts": tokens.op9_token_counts,
    "op10_url_filter": urls.op10_url_filter,
    "op11_licenses": licenses.op11_licenses,
    "op12_whiten": whitening.op12_whiten,
    "op13_repair": conversations.op13_repair,
}
ORACLE_SQL = {"op6_mix": mixing.OP6_SQL, "op7_top_k": topk.OP7_SQL}
