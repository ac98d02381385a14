"""Queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from skylag.llm import decontaminate, language, merkle, near_dups, page_text, preferences, prefix_trie, secrets, token_codes, topk, url_filter, warc, word_bpe

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_codes": token_codes.query,
    "op2_preferences": preferences.query,
    "op3_language": language.query,
    "op4_page_text": page_text.query,
    "op5_topk": topk.query,
    "op6_secrets": secrets.query,
    "op7_decontaminate": decontaminate.query,
    "op8_near_dups": near_dups.query,
    "op9_url_filter": url_filter.query,
    "op10_word_bpe": word_bpe.query,
    "op11_warc": warc.query,
    "op12_prefix_trie": prefix_trie.query,
    "op13_merkle": merkle.query,
}

ORACLE: dict[str, str] = {
    "op2_preferences": preferences.ORACLE_SQL,
    "op5_topk": topk.ORACLE_SQL,
    "op7_decontaminate": decontaminate.ORACLE_SQL,
    "op9_url_filter": url_filter.ORACLE_SQL,
    "op11_warc": warc.ORACLE_SQL,
    "op12_prefix_trie": prefix_trie.ORACLE_SQL,
    "op13_merkle": merkle.ORACLE_SQL,
}
