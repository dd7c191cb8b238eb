r"""Line dedup across documents.

Texts are split at \n; a line's key is the line without ASCII white space at
its ends, ASCII lower case. Keys of at least ``min_chars`` code points held by
at least ``min_docs`` documents lose all their lines except in the largest
doc_id that holds the key. The remaining lines are put together by position.

Only (row key, position, 128-bit key hash) of long lines is exploded; keys are made
distinct inside a row, so the count and the largest id per key combine
map-side and a very common line is one partial row a task. The dropped
positions of a document go back to its text through a join on the row key.
The common keys are stored, so their join with the lines has a shuffle of its
own on either side, whose hot keys the adaptive skew join can split.

Each row counts as a document; a row repeated whole is dropped or kept alike,
and rows of the largest id all keep the line. Null ids are smaller than any
id. Null or empty text is one empty line, and stays so. A text whose lines
all go is one empty text with no line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import SPACES, ascii_lower, row_key, stored


def line_dedup(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """The documents with ``text`` deduplicated, plus n_lines and n_dropped."""
    base = docs.withColumn("__row", row_key(F.col("doc_id"), F.col("text")))
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.transform(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)))
    pairs = F.filter(F.transform(key, lambda x, i: F.struct(i.alias("pos"), F.when(F.length(x) >= min_chars, F.unhex(F.md5(
        ascii_lower(x)))).alias("key"))), lambda x: x["key"].isNotNull())
    rows = base.select("__row", "doc_id", pairs.alias("pairs"))
    keys = rows.select("doc_id", F.explode(F.array_distinct(F.transform("pairs", lambda x: x["key"]))).alias("key"))
    common = stored(keys.groupBy("key").agg(F.count("*").alias("n"), F.max("doc_id").alias("holder"))
                    .where(F.col("n") >= min_docs).select("key", "holder"), "common-lines")
    lines = rows.select("__row", "doc_id", F.explode("pairs").alias("x")).select("__row", "doc_id", F.col("x.pos").alias("pos"), F.col("x.key").alias("key"))
    drop = lines.join(common, "key").where(~F.col("doc_id").eqNullSafe(F.col("holder"))) \
        .groupBy("__row").agg(F.collect_set("pos").alias("__drop"))
    d = base.join(drop, "__row", "left").withColumn("__lines", F.split(text, "\n", -1))
    stay = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__drop"))
    return d.withColumns({
        "n_lines": F.size("__lines").cast("long"), "n_dropped": F.coalesce(F.size("__drop"), F.lit(0)).cast("long"),
        "text": F.when(F.col("__drop").isNull(), F.col("text")).otherwise(
            F.array_join(F.transform(stay, lambda i: F.get(F.col("__lines"), i)), "\n"))}).drop("__row", "__drop", "__lines")


def op7(docs: DataFrame) -> DataFrame:
    d = line_dedup(docs.select("doc_id", "text"))
    return d.select("doc_id", "n_lines", "n_dropped",
                    F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256).alias("kept_sha256"))
