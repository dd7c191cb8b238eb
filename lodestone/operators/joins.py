"""Join strategies with a measured size bound.

A side is broadcast only after it has been materialised (reliable
checkpoint in the shared folder) and counted; above the bound the same
join shuffles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.session import shared_root

# Bounds of a broadcast side: rows, and bytes as counted.
DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def _bytes(df: DataFrame) -> Column:
    """Bytes of a row: the length of its texts and binaries, 16 for every other column."""
    text = [n for n, t in df.dtypes if t in ("string", "binary")]
    total = F.lit(16 * (len(df.columns) - len(text)) + 8)
    for n in text:
        total = total + F.coalesce(F.octet_length(F.col(n)), F.lit(0)) + 8
    return total


def bounded(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
            max_bytes: int = DEFAULT_BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """Materialise ``df`` once and tell whether it is small enough to broadcast:
    at most ``max_rows`` rows and ``max_bytes`` counted bytes. This runs a job
    at once.

    Persist + lazy reliable checkpoint + one count: the count fills the cache,
    the checkpoint files are written from the cache right after that job, so
    the plan runs once and the result survives executor loss."""
    from pyspark import StorageLevel

    shared_root(df.sparkSession)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    ck = cached.checkpoint(eager=False)
    n, size = ck.agg(F.count("*"), F.sum(_bytes(df))).first()
    cached.unpersist(blocking=False)
    return ck, n <= max_rows and (size or 0) <= max_bytes


def left_join_sized(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]],
                    right_small: bool) -> DataFrame:
    """``left LEFT JOIN right``; the right side is broadcast only when measured small."""
    r = F.broadcast(right) if right_small else right
    cond = [left[a] == r[b] for a, b in on]
    return left.join(r, cond, "left")


def preserving_join_small_left(small: DataFrame, big: DataFrame, on: Sequence[tuple[str, str]],
                               big_columns: Sequence[str], small_ok: bool,
                               keys: DataFrame | None = None) -> DataFrame:
    """``small LEFT JOIN big`` where the *preserved* side is the small one.

    Spark can only broadcast the non-preserved side of an outer join, so the
    plain form shuffles the big side by the join key, and a hot key (one day
    holding a third of the rows) lands in one task. When ``small`` is measured
    small the join is rewritten exactly as
        (big INNER JOIN broadcast(small))  UNION ALL  (small ANTI JOIN distinct big keys)
    which streams the big side without any shuffle; the distinct keys are
    combined map-side. Above the bound the same form runs without the hint: an
    inner join, of which the adaptive skew join can split either side, where
    an outer join could not split the big one. ``keys`` may name a frame with
    the distinct keys, if there is one. Output: ``small``'s columns, then ``big_columns``.
    """
    small_cols = small.columns
    s = F.broadcast(small) if small_ok else small
    cond = [s[a] == big[b] for a, b in on]
    matched = big.join(s, cond, "inner").select(*[s[c] for c in small_cols], *[big[c] for c in big_columns])
    if keys is not None:
        big = keys
    big_keys = big.select(*[F.col(b).alias(f"_k{i}") for i, (_, b) in enumerate(on)]).distinct()
    anti_cond = [small[a] == big_keys[f"_k{i}"] for i, (a, _) in enumerate(on)]
    types = dict(big.dtypes)
    unmatched = small.join(big_keys, anti_cond, "left_anti").select(
        *[small[c] for c in small_cols], *[F.lit(None).cast(types[c]).alias(c) for c in big_columns])
    return matched.unionByName(unmatched)
