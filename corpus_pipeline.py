"""From raw documents to a training mix: five stages over the documents table.

Each stage is a function of (spark, docs, sf_dir); its result is written as
Parquet and read again as the next stage's documents. All stages but the last
return the columns of ``documents``. Every document a stage does not decide
against goes on, null and empty texts included (the classifier judges those
like any text). Rows that repeat id and text are merged by the near-duplicate
stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import decontaminate, line_dedup, mixing, near_dedup, quality_classifier
from lodestone.llm.common import read_table, row_key, stored


def _row(text_hash: Column) -> Column:
    """``__row``, a key of a document's id and the hash of its text."""
    return F.concat_ws(".", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), text_hash.cast("string")).alias("__row")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents the quality classifier scores below one half. It learns
    from the labelled rows of the stage's own documents."""
    model = quality_classifier.train(docs, read_table(spark, sf_dir, "labels"))
    return quality_classifier.score(docs, model, "__score").where(F.col("__score") >= 0.5).drop("__score")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take out long lines that five or more documents share; n_chars follows the text."""
    d = line_dedup.line_dedup(docs)
    return d.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate class (five-word shingles, similarity 0.8)."""
    kept = near_dedup.near_dedup(docs).where("leads").select(_row(F.col("text_hash")))
    # both steps on one key: the texts are shuffled once
    one = docs.withColumn("__row", _row(F.xxhash64("text"))).dropDuplicates(["__row"])
    return one.join(kept, "__row", "left_semi").select(docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold ten consecutive words of a benchmark item (or a whole shorter item)."""
    rows = docs.withColumn("row", F.xxhash64("text"))
    judged = decontaminate.decontaminate(rows, read_table(spark, sf_dir, "benchmark"))
    # stored, so that its size is known when the join with the texts is planned
    bad = stored(judged.where("contaminated").select(_row(F.col("row"))).distinct(), "contaminated")
    return docs.withColumn("__row", _row(F.xxhash64("text"))).join(bad, "__row", "left_anti").select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take the documents of each source up to its target: one row per
    document and epoch, with ``epoch`` and ``mix_words``."""
    sizes = mixing.measure(docs.withColumn("row_key", row_key(F.col("doc_id"), F.col("text"))), keep=("row_key",))
    return mixing.expand(docs, mixing.mix(stored(sizes, "mix-sizes")))


STAGES = [("quality_classifier", keep_quality), ("line_dedup", drop_lines), ("near_dedup", drop_near_copies),
          ("decontamination", drop_benchmark), ("mixing", mix_sources)]

# the classifier is learned, which SQL cannot express; tests follow the stages by brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
