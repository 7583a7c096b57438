"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from gridlode.llm import bagminhash, chat, decontamination, html_text, language_model, neighbours, packing, periodic, pii, ranking, sharding, toxicity, url_rules
from gridlode.llm.common import own_batches  # noqa: F401  (for queries that run after these)

QUERIES = {
    "op1_pii": pii.query,
    "op3_toxicity": toxicity.query,
    "op2_html_text": html_text.query,
    "op4_bagminhash": bagminhash.query,
    "op5_url_rules": url_rules.query,
    "op6_neighbours": neighbours.query,
    "op7_packing": packing.query,
    "op8_sharding": sharding.query,
    "op9_language_model": language_model.query,
    "op10_decontamination": decontamination.query,
    "op11_ranking": ranking.query,
    "op12_chat": chat.query,
    "op13_periodic": periodic.query,
}

ORACLE = {
    "op8_sharding": sharding.ORACLE,
    "op11_ranking": ranking.ORACLE,
}
