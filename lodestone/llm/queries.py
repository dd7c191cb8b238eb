"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lodestone.llm import chat_format, decontaminate, divergence, fill_in_middle, line_dedup, lm_scoring, mixing, near_dedup, packing, quality_classifier, quality_rules, secret_scan, suffix_dedup
from lodestone.llm.common import read_table
from lodestone.llm.oracle import SQL


def _over(name: str, fn: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: fn(read_table(spark, sf_dir, name))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": _over("documents", mixing.op1),
    "op2_quality_rules": _over("documents", quality_rules.op2),
    "op3_quality_classifier": quality_classifier.op3,
    "op4_decontamination": lambda spark, sf_dir: decontaminate.op4(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")),
    "op5_lm_scoring": _over("documents", lm_scoring.op5),
    "op6_near_dedup": _over("documents", near_dedup.op6),
    "op7_line_dedup": _over("documents", line_dedup.op7),
    "op8_suffix_dedup": _over("documents", suffix_dedup.op8),
    "op9_secret_scan": _over("documents", secret_scan.op9),
    "op10_chat_format": _over("conversations", chat_format.op10),
    "op11_divergence": _over("documents", divergence.op11),
    "op12_packing": _over("documents", packing.op12),
    "op13_fill_in_middle": _over("documents", fill_in_middle.op13),
}
ORACLE: dict[str, str] = {k: v for k, v in SQL.items() if k in QUERIES}
