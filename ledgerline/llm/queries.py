"""The queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from ledgerline.llm import bpe_codec, chat_format, embedding_dedup, fill_middle, line_rules, lm_score, near_dup, packing
from ledgerline.llm import passages, quality_model, source_audit, url_filter, warc
from ledgerline.plans.registry import Query

QUERIES: dict[str, Query] = {
    "op1_embedding_dedup": Query(embedding_dedup.query, None),
    "op2_packing": Query(packing.query, None),
    "op3_warc": Query(warc.query, warc.SQL),
    "op4_lm_score": Query(lm_score.query, None),
    "op5_near_dup": Query(near_dup.query, None),
    "op6_quality": Query(quality_model.query, None),
    "op7_line_rules": Query(line_rules.query, None),
    "op8_url_filter": Query(url_filter.query, url_filter.SQL),
    "op9_bpe_codec": Query(bpe_codec.query, None),
    "op10_passages": Query(passages.query, None),
    "op11_source_audit": Query(source_audit.query, source_audit.SQL),
    "op12_chat_format": Query(chat_format.query, chat_format.SQL),
    "op13_fill_middle": Query(fill_middle.query, fill_middle.SQL),
}
