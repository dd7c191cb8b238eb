"""Bronze document flattening (FLT-1..6) and envelope checks (ENV-1..4)."""

import json
import os

import pytest
from pyspark.sql import functions as F

from lodestone.operators import envelope, flatten, validate
from lodestone.sources import bronze
from tests.conftest import rows


def docs(spark, *values, day="2026-04-08"):
    return spark.createDataFrame([(day, v) for v in values], "ingested_at string, value string")


METAL_DOC = json.dumps({"status": "success", "currency": "USD", "unit": "g",
                        "metals": {"gold": 137.19, "silver": "2.03", "platinum": None, "copper": -1, "extra": 9},
                        "timestamps": {"metal": "2026-04-08T01:38:03.570Z"}})


def test_metal_follows_configured_list(spark):
    flat = flatten.flatten_metal(envelope.accepted_documents(docs(spark, METAL_DOC), "metal"))
    got = {r["metal_symbol"]: r["price_usd"] for r in flat.collect()}
    # every configured metal, none of the extra keys; nickel absent -> null price
    assert got == {"gold": "137.19", "silver": "2.03", "platinum": None, "copper": "-1", "nickel": None}
    valid, rejected = validate.validate(flat, "metal")
    assert rows(valid, "metal_symbol", "price_usd") == [("gold", 137.19), ("silver", 2.03)]
    assert rejected.count() == 3


def test_metal_fixture_form_is_rejected_entirely(spark):
    # T-16: the test-fixture wire form has no timestamps.metal / currency / unit
    fixture = json.dumps({"timestamp": "2026-02-03T04:05:06.700Z", "status": "success",
                          "metals": {"gold": 88.125}, "currency_base": "USD"})
    flat = flatten.flatten_metal(envelope.accepted_documents(docs(spark, fixture), "metal"))
    valid, rejected = validate.validate(flat, "metal")
    assert valid.count() == 0 and rejected.count() == 5


def test_envelope_errors(spark):
    d = docs(spark, "", "{}", "not json", json.dumps({"status": "error"}), json.dumps({"x": 1}), METAL_DOC)
    got = sorted((r["envelope_error"] or "ok") for r in envelope.check_envelope(d, "metal").collect())
    assert got == ["empty", "empty_object", "not_json", "ok", "status", "status"]
    # rejected documents give no flattened rows at all
    assert flatten.flatten_metal(envelope.accepted_documents(d, "metal")).count() == 5


def test_currency_quoted_numbers_and_missing_code(spark):
    doc = json.dumps({"date": "2026-02-03 00:00:00+00", "base": "USD",
                      "rates": {"IDR": "15432.25", "EUR": "0.81", "JPY": "142.75"}})
    flat = flatten.flatten_currency(docs(spark, doc), ["IDR", "EUR", "USD"])
    valid, rejected = validate.validate(flat, "currency")
    assert rows(valid, "currency_code", "exchange_rate") == [("EUR", 0.81), ("IDR", 15432.25)]
    assert rows(rejected, "currency_code") == [("USD",)]


def test_currency_missing_code_fails_the_job_in_fail_mode(spark):
    # T-4: the reference's float(None) aborts the whole feed
    doc = json.dumps({"date": "2026-02-03", "base": "USD", "rates": {"IDR": "1"}})
    with pytest.raises(Exception):
        flatten.flatten_currency(docs(spark, doc), ["IDR", "USD"], on_missing="fail").collect()


def test_fred_two_step_parse(spark):
    doc = json.dumps({
        "DGS10": {"units": "lin", "observations": [{"date": "2026-04-01", "value": "4.33"},
                                                   {"date": "2026-04-02", "value": "."}]},
        "DTWEXBGS": "this series is broken",
        "CPIAUCSL": {"units": "lin", "observations": []},
        "OTHER": {"units": "lin", "observations": [{"date": "2026-04-01", "value": "1"}]},
    })
    flat = flatten.flatten_fred(envelope.accepted_documents(docs(spark, doc), "fred"))
    assert rows(flat, "series_id", "observation_date", "observation_values") == [
        ("DGS10", "2026-04-01", "4.33"), ("DGS10", "2026-04-02", ".")]
    valid, _ = validate.validate(flat, "fred")
    assert rows(valid, "observation_values") == [(4.33,), (None,)]


def test_news_missing_vs_null_total(spark):
    # T-14: a missing totalResults defaults to 0, a JSON null is rejected
    doc = json.dumps({"gold": {"status": "ok", "totalResults": 1234}, "silver": {"status": "ok"},
                      "platinum": {"status": "ok", "totalResults": None},
                      "copper": {"status": "error", "totalResults": 5}})
    flat = flatten.flatten_news(docs(spark, doc), news_timestamp="2026-04-08T16:00:00")
    got = {r["keywords"]: (r["total_mentions"], r["status"]) for r in flat.collect()}
    assert got == {"gold": ("1234", "ok"), "silver": ("0", "ok"), "platinum": (None, "ok"),
                   "copper": ("5", "error"), "nickel": ("0", "unknown")}
    valid, _ = validate.validate(flat, "news")
    assert rows(valid, "keywords", "total_mentions") == [("gold", 1234), ("silver", 0)]


def test_completeness_is_all_or_nothing(spark):
    full = json.dumps({k: {"status": "ok"} for k in ("gold", "silver", "platinum", "copper", "nickel")})
    part = json.dumps({"gold": {"status": "ok"}})
    got = [r["envelope_error"] for r in envelope.check_envelope(docs(spark, full, part), "news", complete=True)
           .orderBy(F.length("value").desc()).collect()]
    assert got == [None, "incomplete"]


def test_empty_domain_is_an_error():
    # T-21 / ENV-3
    with pytest.raises(ValueError):
        envelope.clean_domain([])
    with pytest.raises(ValueError):
        envelope.clean_domain(["", None])
    assert envelope.clean_domain(["gold", "", "silver"]) == ("gold", "silver")


def test_bronze_round_trip_and_missing_day(spark, tmp_dir):
    root = os.path.join(tmp_dir, "bronze", "metal")
    bronze.write_bronze(docs(spark, METAL_DOC, "", day="2026-04-08"), root)
    back = bronze.read_bronze(spark, root)
    assert rows(back, "ingested_at") == [("2026-04-08",)]           # empty body not written
    assert json.loads(back.first()["value"]) == json.loads(METAL_DOC)
    assert bronze.read_bronze(spark, root, days=["2026-04-09"]).count() == 0


def test_pretty_printed_document_is_one_row(spark, tmp_dir):
    day = os.path.join(tmp_dir, "fred", "ingested_at=2026-04-08")
    os.makedirs(day)
    with open(os.path.join(day, "data.json"), "w") as f:
        json.dump({"DGS10": {"units": "lin", "observations": [{"date": "2026-04-01", "value": "4.33"}]}}, f, indent=2)
    d = bronze.read_bronze(spark, os.path.join(tmp_dir, "fred"), whole_text=True)
    assert d.count() == 1
    assert flatten.flatten_fred(d).count() == 1


def test_gather_responses(spark):
    resp = spark.createDataFrame([
        ("2026-04-08", "gold", '{"status":"ok","totalResults":3}'),
        ("2026-04-08", "silver", '{"status":"ok","totalResults":4}'),
        ("2026-04-09", "gold", '{"status":"ok","totalResults":5}'),
    ], "ingested_at string, key string, body string")
    out = bronze.gather_responses(resp, ["gold", "silver"])
    got = out.collect()
    assert len(got) == 1 and got[0]["ingested_at"] == "2026-04-08"
    assert json.loads(got[0]["value"]) == {"gold": {"status": "ok", "totalResults": 3},
                                           "silver": {"status": "ok", "totalResults": 4}}


def test_ndjson_keeps_nulls(spark):
    df = spark.createDataFrame([("a", None)], "k string, v double")
    line = df.select(bronze.to_ndjson(df).alias("l")).first()["l"]
    assert json.loads(line) == {"k": "a", "v": None}
