"""Mixing sources to target weights.

Every source gets a budget of tokens (its target), and its documents are taken
in the order of a hash-random key until the budget is spent. The order is a
range sort in two steps: the keys are uniform, so ``n_docs / rows_per_bucket``
equal key ranges per source make even buckets (a source with a third of all
rows is just more buckets); a window sorts and sums inside a bucket, and the
prefix sums of the few bucket totals are added. A budget of several times the
source repeats whole epochs; the document at the cut is taken in part, so a
source's taken words are exactly its target rounded down.

Null source is a source of its own, ordered last. Null or empty text has size
0 and is never taken. Equal keys (repeated ids) are ordered by id and size.
Reruns agree: nothing depends on partitioning. Only DataFrame functions run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestone.llm.common import by_rows, row_key, stored, words


def targets(sizes: DataFrame, cycle: int = 3, cap: float = 3.0) -> DataFrame:
    """One row per source: source_size, n_docs, target.

    Weights 1..cycle repeat over the sources in code-point order (null last)
    and share the total size. A target stops at ``cap`` times its source; the
    excess goes to the others by weight until none is above. Sorted by
    cap / weight, the capped sources are a prefix, so one running sum finds
    the final level without iterating.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    per = per.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    per = per.withColumn("weight", (F.col("rank") % cycle + 1).cast("double"))
    per = per.withColumn("most", F.col("source_size").cast("double") * cap)
    whole = Window.partitionBy()
    before = Window.orderBy(F.col("most") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum(F.col("source_size").cast("double")).over(whole) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    per = per.withColumn("capped", F.col("weight") * left / open_weight > F.col("most"))
    spent = F.sum(F.when(F.col("capped"), F.col("most")).otherwise(0.0)).over(whole)
    closed = F.sum(F.when(F.col("capped"), F.col("weight")).otherwise(0.0)).over(whole)
    level = (F.sum(F.col("source_size").cast("double")).over(whole) - spent) / (F.sum("weight").over(whole) - closed)
    return per.select("source", "source_size", "n_docs",
                      F.when(F.col("capped"), F.col("most")).otherwise(F.col("weight") * level).alias("target"))


def measure(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size (words of the text) of every document."""
    return docs.select("doc_id", "source", *keep, F.size(words(F.col("text"))).cast("long").alias("size"))


def mix(sizes: DataFrame, cycle: int = 3, cap: float = 3.0, seed: str = "mix",
        rows_per_bucket: int = 5000) -> DataFrame:
    """``sizes`` (doc_id, source, size, ...) with source_size, target, epochs
    (whole repeats), part (words taken once more) and taken."""
    per = targets(sizes, cycle, cap)
    key = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    d = by_rows(sizes, per, ["source"], "inner").withColumn("key", key)
    unit = F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / float(1 << 32)
    d = d.withColumn("bucket", F.floor(unit * F.ceil(F.col("n_docs") / rows_per_bucket)))

    totals = d.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("source", "bucket", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    d = by_rows(d, offsets, ["source", "bucket"], "inner")

    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    d = d.withColumn("epochs", epochs)
    left = budget - F.col("epochs") * F.col("source_size") - F.col("offset") - F.col("before")
    d = d.withColumn("part", F.least(F.col("size"), F.greatest(F.lit(0), left)).cast("long"))
    d = d.withColumn("taken", F.col("epochs") * F.col("size") + F.col("part"))
    return d.drop("key", "bucket", "n_docs", "before", "offset")


def expand(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """One row per document and epoch of the mix: the document's columns,
    ``epoch`` and ``mix_words``; a text taken in part is cut after that many
    words. ``mixed`` must carry ``row_key``. Rows repeating id and text share
    the first one's other columns."""
    takes = mixed.where(F.col("taken") > 0).groupBy("row_key").agg(
        F.collect_list(F.struct("size", "epochs", "part")).alias("takes"))
    whole = docs.withColumn("row_key", row_key(F.col("doc_id"), F.col("text"))).dropDuplicates(["row_key"])
    one = whole.join(takes, "row_key").withColumn("take", F.explode("takes")).drop("takes", "row_key")
    n = F.col("take.epochs") + (F.col("take.part") > 0).cast("long")
    out = one.withColumn("epoch", F.explode(F.sequence(F.lit(1).cast("long"), n)))
    partly = (F.col("epoch") > F.col("take.epochs")) & (F.col("take.part") < F.col("take.size"))
    out = out.withColumn("mix_words", F.when(partly, F.col("take.part")).otherwise(F.col("take.size")))
    # the text up to the last word taken, with its white space, through one match
    cut = F.when(partly, F.array_join(F.slice(F.regexp_extract_all(
        F.col("text"), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), 0), F.lit(1), F.col("mix_words").cast("int")), ""))
    return out.withColumn("text", F.when(partly, cut).otherwise(F.col("text"))).drop("take")


def op1(docs: DataFrame) -> DataFrame:
    mixed = mix(stored(measure(docs), "mix-sizes"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "epochs")
