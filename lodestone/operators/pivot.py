"""Conditional-max pivot of a few series into columns (AGG-2, FN-9)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pivot_max(df: DataFrame, key: str, value: str, mapping: Sequence[tuple[str, str]]) -> DataFrame:
    """``max(CASE WHEN key = k THEN value END) AS col`` per (k, col); no grouping key,
    so the result is exactly one row (all null over no input)."""
    return df.agg(*[F.max(F.when(F.col(key) == k, F.col(value))).alias(c) for k, c in mapping])
