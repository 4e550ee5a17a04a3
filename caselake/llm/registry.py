"""Queries of the training-data operators and their SQL."""

from __future__ import annotations

import corpus_pipeline
from caselake.llm import (chat, classifier, decontaminate, neardup, pieces, pii, quality, repair, search, secrets,
                          sharding, suffixes, urls)

QUERIES = {
    "op1_suffixes": suffixes.op1_suffixes,
    "op2_secrets": secrets.op2_secrets,
    "op3_sharding": sharding.op3_sharding,
    "op4_quality_rules": quality.op4_quality_rules,
    "op5_pieces": pieces.op5_pieces,
    "op6_pii": pii.op6_pii,
    "op7_chat": chat.op7_chat,
    "op8_decontaminate": decontaminate.op8_decontaminate,
    "op9_quality_classifier": classifier.op9_quality_classifier,
    "op10_neardup": neardup.op10_neardup,
    "op11_repair": repair.op11_repair,
    "op12_search": search.op12_search,
    "op13_urls": urls.op13_urls,
    "pipeline": corpus_pipeline.run,
}

ORACLES = {
    "op2_secrets": secrets.OP2_SQL,
    "op4_quality_rules": quality.OP4_SQL,
    "op7_chat": chat.OP7_SQL,
    "op10_neardup": neardup.OP10_SQL,
    "op11_repair": repair.OP11_SQL,
    "op12_search": search.OP12_SQL,
    "op13_urls": urls.OP13_SQL,
}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
