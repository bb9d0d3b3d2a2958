"""The queries of this subpackage, by name, with their DuckDB oracles.

The last two show what SQL can express of `op5` and `op3`, whose models it can't.
"""

from __future__ import annotations

from . import bagminhash, bpe, chat, decontaminate, divergence, filter_audit, line_crf, line_dedup, ordinal, secrets, suffix_dedup, url_filter, warc

QUERIES = {
    "op1_decontaminate": decontaminate.query,
    "op2_line_dedup": line_dedup.query,
    "op3_url_filter": url_filter.query,
    "op4_bpe": bpe.query,
    "op5_quality_rules": line_crf.query,
    "op6_chat_format": chat.query,
    "op7_warc": warc.query,
    "op8_near_duplicates": bagminhash.query,
    "op9_quality_classifier": ordinal.query,
    "op10_secrets": secrets.query,
    "op11_suffix_dedup": suffix_dedup.query,
    "op12_source_divergence": divergence.query,
    "op13_filter_audit": filter_audit.query,
    "quality_rules_base": line_crf.base_query,
    "url_rules": url_filter.rules_query,
}
ORACLES = {
    "op1_decontaminate": decontaminate.SQL,
    "op2_line_dedup": line_dedup.SQL,
    "op6_chat_format": chat.SQL,
    "op7_warc": warc.SQL,
    "op8_near_duplicates": bagminhash.SQL,
    "op10_secrets": secrets.SQL,
    "op11_suffix_dedup": suffix_dedup.SQL,
    "op12_source_divergence": divergence.SQL,
    "op13_filter_audit": filter_audit.SQL,
    "quality_rules_base": line_crf.BASE_SQL,
    "url_rules": url_filter.RULES_SQL,
}
