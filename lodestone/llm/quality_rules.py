r"""Quality rules with cross-document line frequency.

Per-text rules first (word count, repeated 5-word windows, repeated lines,
symbols), then the corpus rule: every line is normalised (ASCII lower case,
white space collapsed, digits to 0) and hashed; per host the distinct
documents of a line are counted; lines held by more than ``max_docs``
documents of one host are boilerplate; a document whose words are left by
less than ``min_left`` percent after removing them is rejected.

One pass over the texts writes a narrow table (counts and line hashes); only
hashes are shuffled. Lines are made distinct inside each row, so the count per
(host, line) combines map-side and a very common line is one partial row a
task. Repeated rows count as documents of their own. Null or empty text: no
words, base_failed. Null host is a host of its own. A 64-bit hash stands for a
5-word window inside one text. Only DataFrame functions run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import SPACES, ascii_lower, by_rows, stored, words

SYMBOLS = "#*$%&|<>"


def measure(docs: DataFrame, host: str = "source") -> DataFrame:
    """Per document: base counts, and ``lines``: one (hash, words, copies
    included) entry per distinct normalised line."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select("doc_id", F.col(host).alias("host"), text.alias("text"), words(text).alias("w"),
                    F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    w = F.col("w")
    windows = F.when(F.size(w) >= 5, F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - 5, F.lit(0))), lambda i: F.xxhash64(
        *[F.get(w, i + k) for k in range(5)]))).otherwise(F.array().cast("array<bigint>"))
    d = d.select("doc_id", "host", "text", "lines", F.size("w").cast("long").alias("n_words"), windows.alias("h"))
    d = d.withColumn("twice", F.size("h") > F.size(F.array_distinct("h")))
    sorted_h = F.when(F.col("twice"), F.array_sort(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i")))))
    d = d.withColumn("s", sorted_h)
    s = F.col("s")
    again = F.filter(s, lambda x, j: (x["h"] == F.get(s, j - 1)["h"]) | (x["h"] == F.get(s, j + 1)["h"]))
    d = d.withColumn("p", F.when(F.col("twice"), F.array_sort(F.transform(again, lambda x: x["i"]))))
    p = F.col("p")
    gaps = F.transform(p, lambda x, j: F.least(F.lit(5), F.coalesce(F.get(p, j + 1) - x, F.lit(5))))
    repeated = F.when(F.col("twice"), F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x)).otherwise(F.lit(0).cast("long"))
    clean = F.transform("lines", lambda x: F.struct(
        F.xxhash64(F.trim(F.regexp_replace(F.translate(ascii_lower(x), "123456789", "000000000"), r"[\x20\x09-\x0D]+", " "))).alias("line"),
        F.size(words(x)).alias("words")))
    return d.select(
        "doc_id", "host", "n_words",
        F.length(F.translate("text", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(repeated, F.lit(0).cast("long")).alias("n_repeat_words"),
        clean.alias("lines"))


def quality_rules(docs: DataFrame, host: str = "source", min_words: int = 10, max_repeat: int = 20,
                  max_docs: int = 20, min_left: int = 50) -> DataFrame:
    """Base counts, base_failed, n_frequent_words (words on boilerplate lines)
    and kept, one row per document."""
    m = stored(measure(docs, host).withColumn("row", F.monotonically_increasing_id()), "rules")
    line = m.select("host", F.explode(F.array_distinct(F.transform("lines", lambda x: x["line"]))).alias("line"))
    # stored, so that the join has a shuffle of its own, whose hot lines can be split
    often = stored(line.groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") > max_docs).select("host", "line"), "boilerplate")
    each = m.select("row", "host", F.explode("lines").alias("x")).select("row", "host", F.col("x.line").alias("line"), F.col("x.words").alias("words"))
    lost = by_rows(each, often, ["host", "line"], "inner").groupBy("row").agg(F.sum("words").alias("n_frequent_words"))
    d = m.drop("lines").join(lost, "row", "left").withColumn("n_frequent_words", F.coalesce("n_frequent_words", F.lit(0)).cast("long"))
    d = d.withColumn("base_failed", (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words")))
    left = 100 * (F.col("n_words") - F.col("n_frequent_words")) >= min_left * F.col("n_words")
    return d.withColumn("kept", ~F.col("base_failed") & left).drop("row", "host")


def op2(docs: DataFrame) -> DataFrame:
    return quality_rules(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                      "base_failed", "kept", "n_frequent_words")
