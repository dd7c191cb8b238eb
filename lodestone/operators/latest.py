"""Latest row per key (WIN-1/2, FIL-2) and the top-1 fallback (SORT-1, LIM-1).

Ordering is always total: the caller's order columns, then the values
themselves, so ties (the same observation re-fetched by several loads)
resolve the same way on every run and in every engine.

``latest_per_key`` defaults to an aggregate, ``max(struct(order..., values...))``:
a hash aggregate combines map-side, so each task ships one row per key to
the shuffle. That matters when there are only a few keys (three macro
series): a window ``partitionBy(key)`` would route a third of all rows to
one task. The window form is kept for parity checks; with the ``rn = 1``
filter Spark plans a partial ``WindowGroupLimit`` before its exchange, so it
also ships at most one row per key and task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order_desc: Sequence[str], values: Sequence[str],
                   method: str = "aggregate") -> DataFrame:
    """One row per ``keys``: the row greatest by ``order_desc`` (descending, nulls last),
    ties broken by ``values`` (descending, nulls last). Returns ``keys + values``."""
    keys, order_desc, values = list(keys), list(order_desc), list(values)
    if method == "window":
        w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order_desc + values])
        return (df.select(*keys, *order_desc, *values)
                .withColumn("_rn", F.row_number().over(w))
                .where(F.col("_rn") == 1)
                .select(*keys, *values))
    if method != "aggregate":
        raise ValueError(f"unknown method {method!r}")
    # max over a struct compares field by field; a null field sorts lowest,
    # which is "descending, nulls last" on every field. A struct buffer is not
    # hash-aggregatable (Spark plans a sort aggregate), so with one value the
    # rows are first combined per (keys, order) by a map-side hash aggregate:
    # max(value) there is the value tie-break, and the sort aggregate then
    # sees at most one row per distinct (keys, order) per task.
    if len(values) == 1:
        df = df.groupBy(*keys, *order_desc).agg(F.max(values[0]).alias(values[0]))
    names = [f"_o{i}" for i in range(len(order_desc))] + [f"_v{i}" for i in range(len(values))]
    packed = F.struct(*[F.col(c).alias(n) for c, n in zip(order_desc + values, names)])
    best = df.groupBy(*keys).agg(F.max(packed).alias("_best"))
    return best.select(*keys, *[F.col("_best").getField(f"_v{i}").alias(v) for i, v in enumerate(values)])

def top1(df: DataFrame, order_desc: Sequence[str], values: Sequence[str]) -> DataFrame:
    """At most one row: the greatest by ``order_desc`` then ``values`` (LIM-1).

    Planned as TakeOrderedAndProject: a partial top-1 per task, then one merge.
    """
    cols = list(order_desc) + list(values)
    return df.orderBy(*[F.col(c).desc_nulls_last() for c in cols]).limit(1).select(*values)
