"""Registered queries of the training-data operators, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from orrery.llm import bpe, chat, decontaminate, extraction, lempel_ziv, ngram_lm, quality, resampling, secrets, sharding, simhash, spelling, url_filter


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_spaced_seeds": decontaminate.op1,
        "op2_quality_sketches": quality.op2,
        "op3_secret_entropy": secrets.op3,
        "op4_stratified_shards": sharding.op4,
        "op5_backoff_scores": ngram_lm.op5,
        "op6_chunked_bpe": bpe.op6,
        "op7_url_trees": url_filter.op7,
        "op8_chat_grammar": chat.op8,
        "op9_site_templates": extraction.op9,
        "op10_simhash_trie": simhash.op10,
        "op11_trie_pairs": spelling.op11,
        "op12_lempel_ziv": lempel_ziv.op12,
        "op13_prefix_crcs": resampling.op13,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_quality_sketches": quality.OP2_SQL,
        "op3_secret_entropy": secrets.OP3_SQL,
        "op4_stratified_shards": sharding.OP4_SQL,
        "op5_backoff_scores": ngram_lm.OP5_SQL,
        "op8_chat_grammar": chat.OP8_SQL,
        "op11_trie_pairs": spelling.OP11_SQL,
        "op12_lempel_ziv": lempel_ziv.OP12_SQL,
        "op13_prefix_crcs": resampling.OP13_SQL,
    }
