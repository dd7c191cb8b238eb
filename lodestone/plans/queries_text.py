"""Registered queries over texts: JSON of any shape, phrases in documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestone.functions.keys import sanitize_json
from lodestone.operators import mentions
from lodestone.plans import demo
from lodestone.plans.catalog import register

# --- keys of undeclared JSON (JSN-1, JSN-2) ----------------------------------------
# Per order one document in one of four shapes: nested objects and arrays with
# colliding keys, an array at the top, escapes in keys, a scalar; some are broken.

SHAPES = (
    r'''{{"order-key": {k}, "1st": [{{"a.b": 1, "a_b": [2, {{"é x": null}}]}}, "x: \"y\" {{", null, [[{{"deep key": true}}]]]}}''',
    r'''[{{"café": "café", "total price": {{"2nd": {k}}}}}, {k}, []]''',
    r'''{{"a\"b\\c\n": {{"x y": "v\\", "x-y": "\" : "}}, "z": {{}}, "same": 1, "same": {k}}}''',
    r'''"order {k}: \"key\":"''',
    r'''{{"broken": {k}''',
)
CLEANED = (
    r'''{{"_1st":[{{"a_b":[2,{{"__x":null}}]}},"x: \"y\" {{",null,[[{{"deep_key":true}}]]],"order_key":{k}}}''',
    r'''[{{"caf_":"café","total_price":{{"_2nd":{k}}}}},{k},[]]''',
    r'''{{"a_b_c_":{{"x_y":"\" : "}},"same":{k},"z":{{}}}}''',
    r'''"order {k}: \"key\":"''',
)


def _around(text: str) -> tuple[str, str]:
    """The text before and after the (first) place of the order key; further places hold it too."""
    return tuple(text.replace("{{", "{").replace("}}", "}").split("{k}"))


def _sql_text(shape: str) -> str:
    return " || CAST(o_orderkey AS VARCHAR) || ".join("'" + x.replace("'", "''") + "'" for x in _around(shape))


@register("sanitize_json", "SELECT o_orderkey, CASE o_orderkey % 5 " + " ".join(f"WHEN {i} THEN {_sql_text(c)}" for i, c in enumerate(CLEANED)) + " END AS doc FROM orders")
def q_sanitize_json(spark, sf):
    o = demo.table(spark, sf, "orders", per_row_heavy=True).select("o_orderkey")
    key = F.col("o_orderkey").cast("string")
    docs = [F.array_join(F.array(*map(F.lit, _around(s))), "\0") for s in SHAPES]
    doc = F.coalesce(*[F.when(F.col("o_orderkey") % 5 == i, F.replace(d, F.lit("\0"), key)) for i, d in enumerate(docs)])
    return sanitize_json(o.withColumn("doc", doc), "doc")


# --- thousands of phrases (ENV-7) ----------------------------------------------------

N_PHRASES = 5000
_WORDS_SQL = r"regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+')"


@register("phrase_mentions", rf"""
WITH d AS (SELECT row_number() OVER () AS r, {_WORDS_SQL} AS w FROM documents),
start AS (SELECT unnest([array_to_string(w[1:1], ' '), array_to_string(w[5:6], ' '), array_to_string(w[9:11], ' ')]) AS phrase FROM d WHERE len(w) > 10),
phrase AS (SELECT DISTINCT phrase FROM start ORDER BY md5(phrase) LIMIT {N_PHRASES}),
gram AS (SELECT r, unnest(list_concat(w, list_concat(list_transform(range(1, len(w)), lambda i: array_to_string(w[i:i + 1], ' ')),
  list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))))) AS phrase FROM d)
SELECT phrase, CAST(count(DISTINCT r) AS BIGINT) AS mentions FROM gram JOIN phrase USING (phrase) GROUP BY phrase""")
def q_phrase_mentions(spark, sf):
    """Documents that mention each of five thousand words and phrases, which are drawn from the documents themselves."""
    docs = demo.table(spark, sf, "documents", per_row_heavy=True)
    cut = docs.select(mentions.words_of(F.col("text")).alias("w")).where(F.size("w") > 10)
    drawn = cut.select(F.explode(F.array(*[F.array_join(F.slice("w", at, n), " ") for at, n in ((1, 1), (5, 2), (9, 3))])).alias("phrase")).distinct()
    return mentions.phrase_mentions(docs, drawn.orderBy(F.md5("phrase")).limit(N_PHRASES))
