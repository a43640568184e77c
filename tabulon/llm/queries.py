"""The registered queries of this package and their SQL."""

from __future__ import annotations

from tabulon.llm import chat, crosstoken, gif, htmltext, linededup, lmscore, mixing, packing, repair, simhash, topk, toxicity, urlfilter

QUERIES = {
    "op1_chat_formatting": chat.query,
    "op2_simhash_near_dedup": simhash.query,
    "op3_line_dedup": linededup.query,
    "op4_exact_top_k": topk.query,
    "op5_gif_media": gif.query,
    "op6_toxicity": toxicity.query,
    "op7_lm_scoring": lmscore.query,
    "op8_source_mixing": mixing.query,
    "op9_html_main_text": htmltext.query,
    "op10_best_fit_packing": packing.query,
    "op11_url_filters": urlfilter.query,
    "op12_cross_tokenizer": crosstoken.query,
    "op13_conversation_repair": repair.query,
}

ORACLE_SQL = {
    "op1_chat_formatting": chat.SQL,
    "op4_exact_top_k": topk.SQL,
    "op8_source_mixing": mixing.SQL,
    "op11_url_filters": urlfilter.SQL,
    "op13_conversation_repair": repair.SQL,
}
