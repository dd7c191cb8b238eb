"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.session import shared_path

WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read_table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def words(text: Column) -> Column:
    """All maximal runs of characters other than ASCII white space (null text: none)."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), 0)


def row_key(doc_id: Column, text: Column) -> Column:
    """Join key of a document row: its id and a hash of its text. Rows that
    repeat both share the key and get the same answers."""
    return F.concat_ws(".", F.coalesce(doc_id.cast("string"), F.lit("null")),
                       F.xxhash64(F.coalesce(text, F.lit(""))).cast("string"))


def remainder(doc_id: Column, n: int) -> Column:
    """crc32(doc_id as text) mod n (null id: that of the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` into the shared folder and read it back: computed once,
    lineage cut, and readable after the loss of any executor."""
    path = shared_path(df.sparkSession, f"llm-{name}")
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def count_blocks(docs: DataFrame, block_bytes: int, text: str = "text") -> int:
    """How many blocks of about ``block_bytes`` of text the documents fill."""
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(1, -(-int(total) // block_bytes))


def pieces(batch: pa.RecordBatch, text: int, rows: int, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most ``rows`` rows and, but for single longer
    texts, ``size`` bytes in column ``text``: what a task holds at once does
    not grow with the length of its texts."""
    reach = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        most = size + (int(reach[at - 1]) if at else 0)
        end = max(at + 1, min(at + rows, int(np.searchsorted(reach, most, side="right"))))
        yield batch.slice(at, end - at)
        at = end


def by_rows(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Null-safe equi-join on equally named keys, keeping the left names."""
    renamed = right.select(*[F.col(k).alias(f"__{k}") if k in keys else F.col(k) for k in right.columns])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(renamed[f"__{k}"])
        cond = c if cond is None else cond & c
    return left.join(renamed, cond, how).drop(*[f"__{k}" for k in keys])
