"""Exploding without an inferred pre-filter.

For ``explode(e)`` Catalyst infers ``size(e) > 0`` and pushes it toward the
scan (rule InferFiltersFromGenerate). When ``e`` is expensive (a JSON parse,
a text split, a rule array) that filter re-computes it a second time, below
any repartition, i.e. in the scan tasks. ``posexplode_outer`` infers nothing;
dropping its padding row (position null) gives exactly ``explode``'s rows,
null elements included.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_exact(df: DataFrame, keep: Sequence, items: Column, names: Sequence[str],
                  position: str | None = None) -> DataFrame:
    """``df.select(*keep, explode(items).alias(*names))`` (``posexplode`` when
    ``position`` names the index column)."""
    pos = position or "_pos"
    out = df.select(*keep, F.posexplode_outer(items).alias(pos, *names)).where(F.col(pos).isNotNull())
    return out if position else out.drop(pos)
