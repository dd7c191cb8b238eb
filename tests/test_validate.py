"""Validation rules: accept / reject per rule (modelled on the reference's model tests)."""

from lodestone.operators import validate

METAL = "event_timestamp string, metal_symbol string, price_usd string, currency_base string, unit string, ingested_at string"
FX = "rate_date string, currency_code string, exchange_rate string, base_currency string, ingested_at string"
FRED = "series_id string, observation_date string, observation_values string, units string, ingested_at string"
NEWS = "news_timestamp string, keywords string, total_mentions string, status string, ingested_at string"
D = "2026-04-08"


def reasons(spark, schema, feed, data):
    df = spark.createDataFrame(data, schema)
    return [r["reject_reasons"] for r in validate.check(df, feed).orderBy("ingested_at").collect()]


def test_metal_rules(spark):
    data = [
        ("2026-04-08T01:38:03.570Z", "gold", "137.19", "USD", "g", "1"),
        ("2026-04-08T01:38:03Z", "", "137.19", "USD", "g", "2"),        # empty symbol
        ("2026-04-08T01:38:03Z", "gold", "-1", "USD", "g", "3"),        # negative
        ("2026-04-08T01:38:03Z", "gold", "0", "USD", "g", "4"),         # zero
        ("2026-04-08T01:38:03Z", "gold", "NaN", "USD", "g", "5"),       # T-6
        (None, "gold", "1", "USD", "g", "6"),                           # no timestamp
        ("2026-04-08T01:38:03Z", "gold", "1", None, "g", "7"),          # no currency
        ("2026-04-08T01:38:03Z", "gold", "1", "", "", "8"),             # empty strings are accepted
        ("2026-04-08T01:38:03Z", "gold", None, "USD", "g", "9"),        # missing price
    ]
    assert reasons(spark, METAL, "metal", data) == [
        [], ["VAL-2"], ["VAL-3"], ["VAL-3"], ["VAL-3"], ["VAL-1"], ["VAL-4"], [], ["VAL-3"]]


def test_currency_rules(spark):
    data = [
        ("2025-12-12 00:00:00+00", "IDR", "15432.25", "USD", "1"),
        ("2025-12-12 00:00:00+00:00", "EUR", "0.81", "USD", "2"),
        ("2025-12-12", "JPY", "0", "USD", "3"),
        ("2025-12-12", "JPY", "-1", "USD", "4"),
        ("garbage", "JPY", "1", "USD", "5"),
        ("2025-12-12", "JPY", "1", None, "6"),
    ]
    assert reasons(spark, FX, "currency", data) == [[], [], ["VAL-7"], ["VAL-7"], ["VAL-5"], ["VAL-8"]]


def test_fred_dot_is_kept_as_null_and_negative_rejected(spark):
    data = [
        ("DGS10", "2026-04-01", "4.33", "lin", "1"),
        ("CPIAUCSL", "2025-10-01", ".", "lin", "2"),
        ("CPIAUCSL", "2025-10-01", None, "lin", "3"),
        ("DGS10", "2026-04-01", "-0.1", "lin", "4"),
        ("DGS10", "2026-04-01", "n/a", "lin", "5"),
        ("DGS10", "2026-04-01", "4.3", None, "6"),
        ("DGS10", "bad", "4.3", "lin", "7"),
    ]
    df = validate.check(__import__("pyspark").sql.SparkSession.getActiveSession().createDataFrame(data, FRED), "fred")
    got = {r["ingested_at"]: (r["observation_values"], r["reject_reasons"]) for r in df.collect()}
    assert got["1"] == (4.33, [])
    assert got["2"] == (None, []) and got["3"] == (None, [])
    assert got["4"][1] == ["VAL-11"] and got["5"][1] == ["VAL-11"]
    assert got["6"][1] == ["VAL-9"] and got["7"][1] == ["VAL-9"]


def test_news_rules_zero_allowed(spark):
    data = [
        ("2026-04-08T11:00:00", "gold", "1234", "ok", "1"),
        ("2026-04-08T11:00:00", "gold", "0", "ok", "2"),
        ("2026-04-08T11:00:00", "gold", "-1", "ok", "3"),
        ("2026-04-08T11:00:00", "gold", "5", "error", "4"),
        ("2026-04-08T11:00:00", "gold", None, "ok", "5"),
        ("2026-04-08T11:00:00", None, "5", "ok", "6"),
    ]
    assert reasons(spark, NEWS, "news", data) == [[], [], ["VAL-12"], ["VAL-13"], ["VAL-12"], ["VAL-14"]]


def test_split_is_complete(spark):
    data = [("2026-04-08T01:00:00", "gold", p, "USD", "g", D) for p in ("1", "-1", "2", "x", None)]
    df = spark.createDataFrame(data, METAL)
    valid, rejected = validate.validate(df, "metal")
    assert valid.count() == 2 and rejected.count() == 3
    assert set(valid.columns) == {"event_timestamp", "metal_symbol", "price_usd", "currency_base", "unit", "ingested_at"}


def test_reject_summary_counts(spark):
    data = [("2026-04-08T01:00:00", s, p, "USD", "g", D) for s, p in (("", "-1"), ("gold", "-1"), ("gold", "1"))]
    got = {(r["rule_id"], r["n_rows"]) for r in validate.reject_summary(
        validate.check(spark.createDataFrame(data, METAL), "metal"), "metal").collect()}
    assert got == {("VAL-2", 1), ("VAL-3", 2)}
