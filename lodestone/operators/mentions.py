"""Keyword hit counts over a text table (ENV-7, re-aimed).

The reference asks a news API for the number of articles matching each
keyword. Here the articles are a document table and the count is the
number of documents whose text contains the keyword, a word or a phrase of
words, between non-word characters (case-insensitive, the whole text). One
regular expression scans a text and keeps the longest keyword at each place;
keywords that such a phrase begins with are hits as well. Only hits are
exploded; counts are combined map-side.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions.generators import explode_exact
from lodestone.functions.text import WORD_SPLIT
from lodestone.operators.envelope import clean_domain
from lodestone.operators.joins import bounded


def keyword_hits(docs: DataFrame, keywords: Sequence[str], text_col: str = "text",
                 keep: Sequence[str] = ()) -> DataFrame:
    """One row per (document, keyword it mentions), with the ``keep`` columns."""
    kws = sorted({" ".join(k.lower().split()) for k in clean_domain(keywords, "keywords")}, key=lambda k: (-len(k), k))
    quoted = "|".join(r"[^\p{L}\p{N}]+".join(re.escape(w) for w in k.split()) for k in kws)
    text = F.lower(F.col(text_col))
    found = F.regexp_extract_all(text, F.lit(rf"(?<![\p{{L}}\p{{N}}])(?=({quoted})(?![\p{{L}}\p{{N}}]))"), 1)
    found = F.array_distinct(F.transform(found, lambda x: F.regexp_replace(x, WORD_SPLIT, " ")))
    begun = {k: [s for s in kws if k == s or k.startswith(s + " ")] for k in kws}
    if any(len(v) > 1 for v in begun.values()):
        table = F.create_map(*[x for k, v in begun.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
        found = F.array_distinct(F.flatten(F.transform(found, lambda x: table[x])))
    return explode_exact(docs, list(keep), found, ["keyword"])


def keyword_mentions(spark: SparkSession, docs: DataFrame, keywords: Sequence[str],
                     text_col: str = "text", by: Sequence[str] = ()) -> DataFrame:
    """Documents mentioning each keyword, per ``by`` group. Without ``by`` every
    configured keyword gets a row, zero included (left join from the list)."""
    counts = keyword_hits(docs, keywords, text_col, by).groupBy(*by, "keyword").agg(
        F.count("*").alias("mentions"))
    if by:
        return counts
    domain = spark.createDataFrame([(" ".join(k.lower().split()),) for k in clean_domain(keywords, "keywords")], "keyword string")
    return domain.join(counts, "keyword", "left").select(
        "keyword", F.coalesce("mentions", F.lit(0).cast("bigint")).alias("mentions"))


def phrase_hits(docs: DataFrame, phrases: DataFrame, text_col: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """One row per (document, phrase it mentions) for any number of phrases
    (a frame with a ``phrase`` column): words and phrases of words, as in
    ``keyword_hits``.

    A regular expression tries every keyword at every place; here a text is cut into words
    once, and for each length that phrases have its distinct word n-grams are
    joined with the phrases of that length, so the cost does not depend on
    how many there are. The join is on a 64-bit hash and compares the
    words as well. Phrases are broadcast after their size is measured; beyond
    the bound the join shuffles."""
    p = phrases.select(F.array_join(words_of(F.col("phrase")), " ").alias("phrase")).where("phrase != ''").distinct()
    p, small = bounded(p.withColumn("hash", F.xxhash64("phrase")).withColumn("n_words", F.size(F.split("phrase", " "))))
    lengths = sorted(r[0] for r in p.select("n_words").distinct().collect())  # as many as there are lengths
    if not lengths:
        return docs.select(*keep, F.lit("").alias("phrase")).limit(0)
    cut = docs.select(*keep, words_of(F.col(text_col)).alias("__words"))
    found = None
    for n in lengths:
        each = explode_exact(cut, list(keep), _grams("__words", n), ["gram"]).withColumn("hash", F.xxhash64("gram"))
        of_length = p.where(F.col("n_words") == n).select("hash", "phrase")
        one = each.join(F.broadcast(of_length) if small else of_length, "hash").where(F.col("gram") == F.col("phrase")).select(*keep, "phrase")
        found = one if found is None else found.unionByName(one)
    return found


def _grams(words: str, n: int) -> Column:
    """The distinct runs of ``n`` words, as text."""
    last = F.size(words) - (n - 1)
    places = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(places, lambda i: F.array_join(F.slice(words, i, n), " ")))


def phrase_mentions(docs: DataFrame, phrases: DataFrame, text_col: str = "text", by: Sequence[str] = ()) -> DataFrame:
    """Documents mentioning each phrase, per ``by`` group; phrases without any have no row."""
    return phrase_hits(docs, phrases, text_col, by).groupBy(*by, "phrase").agg(F.count("*").alias("mentions"))


def words_of(text: Column) -> Column:
    """Lower-case words: runs of letters and digits (null text: none)."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), 0)
