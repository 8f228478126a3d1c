"""The registered queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from opsmart.llm import (
    ann,
    bpe,
    chat,
    filteraudit,
    html,
    langid,
    mixing,
    pii,
    repair,
    rules,
    secretscan,
    simhash,
    suffixes,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": suffixes.op1_suffix_dedup,
    "op2_ann": ann.op2_ann,
    "op3_langid": langid.op3_langid,
    "op4_mix": mixing.op4_mix,
    "op5_pii": pii.op5_pii,
    "op6_simhash": simhash.op6_simhash,
    "op7_quality_rules": rules.op7_quality_rules,
    "op8_chat": chat.op8_chat,
    "op9_html": html.op9_html,
    "op10_bpe": bpe.op10_bpe,
    "op11_filter_audit": filteraudit.op11_filter_audit,
    "op12_secret_scan": secretscan.op12_secret_scan,
    "op13_repair": repair.op13_repair,
}

SQL: dict[str, str] = {
    "op4_mix": mixing.OP4_SQL,
    "op8_chat": chat.OP8_SQL,
    "op11_filter_audit": filteraudit.OP11_SQL,
}
