"""Registered queries of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sonorum.llm import alignment, chat_format, decontaminate, langid, mixing, parity, quality, rule_ledger, simhash, suffix_dedup, toxicity, url_rules, whitening


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_decontaminate": decontaminate.op1_decontaminate,
        "op2_source_mix": mixing.op2_source_mix,
        "op3_toxicity": toxicity.op3_toxicity,
        "op4_quality": quality.op4_quality,
        "op5_url_filter": url_rules.op5_url_filter,
        "op6_rule_ledger": rule_ledger.op6_rule_ledger,
        "op6_rule_ablation": rule_ledger.op6_ablation,
        "op7_chat_format": chat_format.op7_chat_format,
        "op8_simhash": simhash.op8_simhash,
        "op9_suffix_dedup": suffix_dedup.op9_suffix_dedup,
        "op10_language_id": langid.op10_language_id,
        "op11_whitening": whitening.op11_whitening,
        "op12_jaccard_join": parity.op12_jaccard_join,
        "op13_token_alignment": alignment.op13_token_alignment,
    }


def oracle_sql() -> dict[str, str]:
    """Operators that SQL can express; the others are tested against brute force or held-out rows."""
    return {
        "op5_url_filter": url_rules.ORACLE_SQL,
        "op6_rule_ledger": rule_ledger.ORACLE_SQL,
        "op6_rule_ablation": rule_ledger.ABLATION_SQL,
        "op7_chat_format": chat_format.ORACLE_SQL,
        "op9_suffix_dedup": suffix_dedup.ORACLE_SQL,
    }
