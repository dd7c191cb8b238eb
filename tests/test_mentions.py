"""Keyword hit counts (ENV-7)."""

from lodestone.operators.mentions import keyword_mentions, phrase_mentions


def test_word_match_case_insensitive_zero_kept(spark):
    docs = spark.createDataFrame([
        (1, "Gold rallies; gold and SILVER up.", "en"), (2, "golden silverware", "en"),
        (3, "Le prix de l'or (gold) monte", "fr"),
    ], "doc_id long, text string, lang string")
    got = {r["keyword"]: r["mentions"] for r in keyword_mentions(spark, docs, ["gold", "silver", "nickel"]).collect()}
    assert got == {"gold": 2, "silver": 1, "nickel": 0}   # documents, not occurrences; no prefix match
    by = {(r["lang"], r["keyword"]): r["mentions"]
          for r in keyword_mentions(spark, docs, ["gold"], by=["lang"]).collect()}
    assert by == {("en", "gold"): 1, ("fr", "gold"): 1}


def test_whole_text_is_searched(spark):
    long_text = "word " * 50_000 + "nickel"
    docs = spark.createDataFrame([(1, long_text)], "doc_id long, text string")
    got = {r["keyword"]: r["mentions"] for r in keyword_mentions(spark, docs, ["nickel"]).collect()}
    assert got == {"nickel": 1}


def test_phrases_and_words_they_begin_with(spark):
    docs = spark.createDataFrame([(1, "Crude oil up"), (2, "crude, OIL"), (3, "crudeoil crude"), (4, "oil"), (5, None)], "id int, text string")
    got = {r["keyword"]: r["mentions"] for r in keyword_mentions(spark, docs, ["crude oil", "Crude", "oil", "a.b"]).collect()}
    assert got == {"crude oil": 2, "crude": 3, "oil": 3, "a.b": 0}


def test_any_number_of_phrases(spark):
    """The same hits as the regular expression of ``keyword_mentions``, for phrases of several lengths, some in others."""
    import random
    r = random.Random(4)
    words = ["gold", "Ore", "price", "öl", "x1", "a"]
    texts = [(i, r.choice([" ", ", ", "\n"]).join(r.choice(words) for _ in range(r.randint(0, 12))), i % 2) for i in range(200)] + [(300, None, 0), (301, "", 1)]
    docs = spark.createDataFrame(texts, "id int, text string, half int")
    phrases = sorted({" ".join(r.choice(words) for _ in range(r.randint(1, 4))) for _ in range(150)})
    frame = spark.createDataFrame([(p,) for p in [*phrases, "Gold  ORE", "gold ore", "", "..", None]], "phrase string")
    want = {x["keyword"]: x["mentions"] for x in keyword_mentions(spark, docs, [*phrases, "gold ore"]).collect() if x["mentions"]}
    assert {x["phrase"]: x["mentions"] for x in phrase_mentions(docs, frame).collect()} == want
    by = phrase_mentions(docs, frame, by=["half"])
    assert {x["phrase"]: x["n"] for x in by.groupBy("phrase").agg({"mentions": "sum"}).withColumnRenamed("sum(mentions)", "n").collect()} == want
    assert phrase_mentions(docs, frame.limit(0)).collect() == []


def test_cost_does_not_grow_with_the_phrases(spark):
    """One join for each length, and no expression that lists phrases."""
    docs = spark.createDataFrame([(1, "a b c")], "id int, text string")
    few, many = (spark.range(n).selectExpr("concat('w', id, ' v') as phrase") for n in (10, 5000))
    plans = [phrase_mentions(docs, p)._jdf.queryExecution().optimizedPlan().toString() for p in (few, many)]
    assert plans[0].count("Join") == plans[1].count("Join") == 1 and len(plans[1]) < 1.1 * len(plans[0])
