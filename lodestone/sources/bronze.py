"""Bronze JSON documents: read, write, gather, NDJSON (SRC-1, SRC-2, SRC-13, SRC-16/17).

Layout: ``<root>/<feed>/ingested_at=<yyyy-MM-dd>/part-*.txt``, one JSON
document per line. Reading the feed root and filtering the partition makes a
missing day zero rows instead of a path error; malformed text is kept as a
row so the envelope check can reject it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.operators.envelope import clean_domain

BRONZE_SCHEMA = "value string, ingested_at string"


def read_bronze(spark: SparkSession, feed_root: str, days: Sequence[str] | None = None,
                whole_text: bool = False) -> DataFrame:
    """SRC-1: (ingested_at, value). ``whole_text`` reads a pretty-printed file
    as one document; otherwise each line is a document (NDJSON)."""
    df = spark.read.option("basePath", feed_root).schema(BRONZE_SCHEMA).text(feed_root, wholetext=whole_text)
    df = df.select("ingested_at", "value")
    if days is not None:
        df = df.where(F.col("ingested_at").isin(list(days)))
    if not whole_text:
        df = df.where(F.length(F.trim("value")) > 0)
    return df


def write_bronze(docs: DataFrame, feed_root: str) -> None:
    """SRC-2: one line per document, day partitions replaced on re-run; empty
    documents are not written (ENV-1)."""
    out = docs.where(F.length(F.trim("value")) > 0).select("value", "ingested_at")
    (out.hint("rebalance", "ingested_at").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("ingested_at").text(feed_root))


def gather_responses(responses: DataFrame, domain: Sequence[str], key_col: str = "key",
                     body_col: str = "body", fetched_col: str | None = None) -> DataFrame:
    """SRC-16/17: per-key responses of one load day -> one document
    ``{key: response}``. All-or-nothing: a day missing any configured key
    yields no document (ENV-4). Empty keys are skipped (ENV-3).

    Input: (ingested_at, key, body JSON text) and, where a key may be fetched
    again, the fetch time ``fetched_col``: the newest fetch of a day counts.
    Several fetches without a time are an error, not a guess. A day holds one response per
    configured key, so the per-day group is bounded by the domain size."""
    keys = clean_domain(domain, "keys")
    # One response per (day, key) first, so the per-day list is bounded by the domain.
    wanted = responses.where(F.col(key_col).isin(list(keys)))
    if fetched_col:
        newest = F.max(F.struct(F.col(fetched_col).alias("at"), F.col(body_col).alias("body")))["body"]
    else:
        newest = F.when(F.min(body_col) == F.max(body_col), F.max(body_col)).otherwise(
            F.raise_error(F.lit("several responses of one day and key: name the fetch time column")))
    r = wanted.groupBy("ingested_at", key_col).agg(newest.alias(body_col))
    per_day = r.groupBy("ingested_at").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col(key_col), F.col(body_col)))).alias("m"),
        F.count("*").alias("n"))
    complete = per_day.where(F.col("n") == len(keys))
    # The bodies are JSON text; splice them into one object without re-parsing.
    def member(e):
        quoted_key = F.regexp_extract(F.to_json(F.array(e["key"])), r"^\[(.*)\]$", 1)
        return F.concat(quoted_key, F.lit(":"), e["value"])

    body = F.concat(F.lit("{"), F.array_join(F.transform(F.map_entries("m"), member), ","), F.lit("}"))
    return complete.select("ingested_at", body.alias("value"))


def to_ndjson(df: DataFrame) -> Column:
    """SRC-13 / JSN-3: a row as one JSON line, null fields kept, non-ASCII kept."""
    return F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"})
