"""Question and answer between blocks of documents and hash shards.

An operator that needs corpus-wide facts about very many small items (n-grams,
suffixes) would shuffle one row per item. Here a task turns a block of
documents, a few megabytes of text, into one packed list of distinct items per
shard; a shard combines the lists of all blocks and answers each one; the
block is read again and finished with its answers. An item is sent once per
block however often it occurs there, so a very frequent item costs a shard no
more than one entry per block. Blocks hold a bounded size of text, shards a
bounded share of the items; both grow in number with the input.

Blocks are made by hash of the row, so the same rows meet again on any retry.
The text exchange is one plan node, which Spark reuses for every reading.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NOTE = "block int, shard int, data binary"


def in_blocks(docs: DataFrame, n_blocks: int, *extra) -> DataFrame:
    """doc_id, text (UTF-8 binary, null as empty), ``extra`` and block."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *extra)
    return d.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)).cast("int")) \
        .withColumn("text", F.col("text").cast("binary"))


def ask(blocked: DataFrame, question: Callable) -> DataFrame:
    return blocked.groupBy("block").applyInPandas(question, NOTE)


def answer(asked: DataFrame, reply: Callable) -> DataFrame:
    return asked.groupBy("shard").applyInPandas(reply, NOTE)


def finish(blocked: DataFrame, answers: DataFrame, last: Callable, schema: str) -> DataFrame:
    return blocked.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(last, schema)


# ------------------------------------------------------------- packed arrays

def planes(a: np.ndarray) -> bytes:
    """Bytes of an integer array, byte plane by byte plane: the many zero
    bytes of small numbers stand together, and compress away."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()


def unplanes(data, n: int, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    if not n:
        return np.zeros(0, dtype)
    raw = np.frombuffer(data, np.uint8, n * size).reshape(size, n)
    return np.ascontiguousarray(raw.T).reshape(-1).view(dtype)


def pack_sorted(a: np.ndarray) -> bytes:
    """Sorted uint64 numbers as differences."""
    return planes(np.diff(a, prepend=np.uint64(0)))


def unpack_sorted(data, n: int) -> np.ndarray:
    return np.cumsum(unplanes(data, n, np.uint64), dtype=np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """Scramble uint64 numbers, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shard_cuts(keys: np.ndarray, n_shards: int, bits: int = 64) -> np.ndarray:
    """Where each shard's part of sorted uniform keys of so many bits begins (and the end)."""
    edges = [(s << bits) // n_shards for s in range(1, n_shards)]
    return np.concatenate([[0], np.searchsorted(keys, np.array(edges, np.uint64)), [len(keys)]]).astype(np.int64)
