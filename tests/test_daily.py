"""End to end: bronze days -> silver (batch and streaming) -> mart."""

import json
import os

from lodestone.plans import daily
from lodestone.sources import bronze, silver
from lodestone.streaming.landing import start_landing
from tests.conftest import rows


def land(spark, root, feed, day, doc):
    df = spark.createDataFrame([(day, json.dumps(doc))], "ingested_at string, value string")
    bronze.write_bronze(df, os.path.join(root, feed))


def fixture_docs(day, gold, idr, dgs10):
    return {
        "metal": {"status": "success", "currency": "USD", "unit": "g",
                  "metals": {"gold": gold, "silver": 2.0, "platinum": -1, "copper": 0.01, "nickel": 0.02},
                  "timestamps": {"metal": f"{day}T01:00:00Z"}},
        "currency": {"date": f"{day} 00:00:00+00", "base": "USD",
                     "rates": {c: str(v) for c, v in zip(("USD", "IDR", "EUR", "JPY", "GBP", "AUD", "CAD", "CNY", "SGD"),
                                                           (1, idr, 0.9, 150, 0.8, 1.5, 1.4, 7.2, 1.3))}},
        "fred": {"DGS10": {"units": "lin", "observations": [{"date": day, "value": str(dgs10)}]},
                 "DTWEXBGS": {"units": "lin", "observations": [{"date": day, "value": "120.5"}]},
                 "CPIAUCSL": {"units": "lin", "observations": [{"date": "2025-10-01", "value": "."}]}},
        "news": {"gold": {"status": "ok", "totalResults": 10}, "silver": {"status": "ok", "totalResults": 0},
                 "platinum": {"status": "error"}, "copper": {"status": "ok"}, "nickel": {"status": "ok",
                                                                                          "totalResults": 3}},
    }


def test_daily_batch_pipeline(spark, tmp_dir):
    b, s, m = (os.path.join(tmp_dir, x) for x in ("bronze", "silver", "mart"))
    for day, gold, idr, y in (("2026-04-07", 100.0, 16000, 4.3), ("2026-04-08", 101.0, 16100, 4.4)):
        for feed, doc in fixture_docs(day, gold, idr, y).items():
            land(spark, b, feed, day, doc)
    for day in ("2026-04-07", "2026-04-08"):
        for feed in ("metal", "currency", "fred", "news"):
            daily.land_to_silver(spark, b, s, feed, day, run_ts=f"{day}T16:00:00")
    again = daily.land_to_silver(spark, b, s, "metal", "2026-04-08")           # re-run: same table
    assert again == {"accepted": 4, "rejected": 1}
    assert silver.read_silver(spark, os.path.join(s, "metal"), "metal").count() == 8
    rejects = spark.read.parquet(os.path.join(s, "_rejects", "news"))
    assert rows(rejects, "keywords", "reject_reasons") == [("platinum", "VAL-13"), ("platinum", "VAL-13")]
    daily.build_mart(spark, s, m, run_date="2026-04-08")
    fact = daily.read_mart(spark, m)
    got = rows(fact.where("commodity_code = 'gold'"), "trade_date", "usd_to_idr", "news_hype_count", "yield_10y",
               "usd_index", "cpi_index")
    assert [(str(r[0]),) + r[1:] for r in got] == [
        ("2026-04-07", 16000.0, 10, 4.4, 120.5, None), ("2026-04-08", 16100.0, 10, 4.4, 120.5, None)]
    # the partition window hides days before the start date
    daily.build_mart(spark, s, m, run_date="2026-04-08", start="2026-04-08")
    assert {str(r["trade_date"]) for r in daily.read_mart(spark, m).collect()} == {"2026-04-08"}


def test_failed_build_leaves_the_mart(spark, tmp_dir):
    import pytest
    from pyspark.sql import functions as F

    from lodestone import schemas

    m = os.path.join(tmp_dir, "mart")
    cols = [F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.struct(schemas.FACT) if f.name != "trade_date"]
    fact = spark.range(2).select(F.date_add(F.lit("2026-04-07").cast("date"), F.col("id").cast("int")).alias("trade_date"), *cols)
    first = daily.write_mart(fact, m)
    bad = fact.withColumn("trade_date", F.when(F.col("trade_date") > "2000-01-01", F.raise_error(F.lit("no rates"))).otherwise(F.col("trade_date")))
    with pytest.raises(Exception, match="no rates"):
        daily.write_mart(bad, m)
    assert daily.current_build(spark, m) == first and daily.read_mart(spark, m).count() == 2
    second = daily.write_mart(fact.limit(1), m)  # days that are gone do not stay
    assert daily.current_build(spark, m) == second and daily.read_mart(spark, m).count() == 1
    assert daily.read_fact(spark, first).count() == 2


def test_streaming_landing_processes_each_file_once(spark, tmp_dir):
    b, s, ck = (os.path.join(tmp_dir, x) for x in ("bronze", "silver", "ckpt"))
    land(spark, b, "metal", "2026-04-07", fixture_docs("2026-04-07", 100.0, 1, 1)["metal"])
    start_landing(spark, b, s, "metal", ck).awaitTermination()
    land(spark, b, "metal", "2026-04-08", fixture_docs("2026-04-08", 101.0, 1, 1)["metal"])
    start_landing(spark, b, s, "metal", ck).awaitTermination()
    got = silver.read_silver(spark, os.path.join(s, "metal"), "metal")
    assert rows(got.where("metal_symbol = 'gold'"), "ingested_at", "price_usd") == [
        ("2026-04-07", 100.0), ("2026-04-08", 101.0)]
    assert got.count() == 8


def test_cli_land_and_mart(spark, tmp_dir):
    from lodestone import cli

    b, s, m = (os.path.join(tmp_dir, x) for x in ("bronze", "silver", "mart"))
    for feed, doc in fixture_docs("2026-04-08", 100.0, 16000, 4.3).items():
        land(spark, b, feed, "2026-04-08", doc)
    for feed in ("metal", "currency", "fred", "news"):
        assert cli.main(["land", "--bronze", b, "--silver", s, "--feed", feed, "--run-date", "2026-04-08"]) == 0
    assert cli.main(["build-mart", "--silver", s, "--mart", m, "--run-date", "2026-04-08"]) == 0
    assert daily.read_mart(spark, m).count() == 4


def test_several_documents_in_one_day_file(spark, tmp_dir):
    b, s = os.path.join(tmp_dir, "bronze"), os.path.join(tmp_dir, "silver")
    docs = [json.dumps(fixture_docs("2026-04-08", p, 1, 1)["metal"]) for p in (100.0, 101.0)]
    df = spark.createDataFrame([("2026-04-08", d) for d in docs], "ingested_at string, value string")
    bronze.write_bronze(df, os.path.join(b, "metal"))
    assert daily.land_to_silver(spark, b, s, "metal", "2026-04-08") == {"accepted": 8, "rejected": 2}


def metal(price):
    return fixture_docs("2026-04-08", price, 1, 1)["metal"]


def put_file(root, day, name, text):
    os.makedirs(os.path.join(root, "metal", f"ingested_at={day}"), exist_ok=True)
    with open(os.path.join(root, "metal", f"ingested_at={day}", name), "w") as f:
        f.write(text)


def test_stream_rebuilds_whole_days(spark, tmp_dir):
    for cap in (None, 1):
        b, s, ck = (os.path.join(tmp_dir, str(cap), x) for x in ("bronze", "silver", "ckpt"))
        for k in range(3):
            put_file(b, "2026-04-08", f"f{k}.txt", json.dumps(metal(100.0 + k)))
        start_landing(spark, b, s, "metal", ck, max_files_per_trigger=cap).awaitTermination()
        count = lambda: silver.read_silver(spark, os.path.join(s, "metal"), "metal").count()
        assert count() == 12
        put_file(b, "2026-04-08", "f3.txt", json.dumps(metal(104.0)))
        for _ in range(2):
            start_landing(spark, b, s, "metal", ck, max_files_per_trigger=cap).awaitTermination()
            assert count() == 16


def test_refused_documents_are_rejects_until_repaired(spark, tmp_dir):
    b, s = os.path.join(tmp_dir, "bronze"), os.path.join(tmp_dir, "silver")
    put_file(b, "2026-04-08", "f.txt", json.dumps({"status": "error"}) + "\n{broken\n{}\n")
    assert daily.land_to_silver(spark, b, s, "metal", "2026-04-08") == {"accepted": 0, "rejected": 3}
    rejects = spark.read.parquet(os.path.join(s, "_rejects", "metal"))
    assert rows(rejects, "level", "reject_reasons") == [("document", "empty_object"), ("document", "not_json"), ("document", "status")]
    good = metal(100.0)
    good["metals"]["platinum"] = 3.0
    put_file(b, "2026-04-08", "f.txt", json.dumps(good))
    assert daily.land_to_silver(spark, b, s, "metal", "2026-04-08") == {"accepted": 5, "rejected": 0}
    assert spark.read.parquet(os.path.join(s, "_rejects", "metal")).count() == 0


def test_whole_text_incomplete_and_missing_rates(spark, tmp_dir):
    import pytest

    b, s = os.path.join(tmp_dir, "bronze"), os.path.join(tmp_dir, "silver")
    put_file(b, "2026-04-08", "f.txt", json.dumps(metal(100.0), indent=1))
    assert daily.land_to_silver(spark, b, s, "metal", "2026-04-08", whole_text=True) == {"accepted": 4, "rejected": 1}
    land(spark, b, "news", "2026-04-08", {"gold": {"status": "ok", "totalResults": 1}})
    assert daily.land_to_silver(spark, b, s, "news", "2026-04-08") == {"accepted": 0, "rejected": 1}
    land(spark, b, "currency", "2026-04-08", {"date": "2026-04-08 00:00:00+00", "base": "USD", "rates": {"IDR": "1"}})
    with pytest.raises(Exception, match="currency rate missing"):
        daily.land_to_silver(spark, b, s, "currency", "2026-04-08")
    assert daily.land_to_silver(spark, b, s, "currency", "2026-04-08", on_missing="skip")["accepted"] == 1


def test_newest_fetch_counts(spark):
    import pytest

    df = spark.createDataFrame([("d", "k", '{"n":9}', 1), ("d", "k", '{"n":10}', 2)], "ingested_at string, key string, body string, at int")
    assert rows(bronze.gather_responses(df, ["k"], fetched_col="at"), "value") == [('{"k":{"n":10}}',)]
    with pytest.raises(Exception, match="fetch time"):
        bronze.gather_responses(df, ["k"]).collect()


def test_gather_lands_one_document_or_none(spark, tmp_dir):
    from lodestone import cli, config

    b, p = os.path.join(tmp_dir, "bronze"), os.path.join(tmp_dir, "responses.json")

    def gather(keys):
        with open(p, "w") as f:
            for k in keys:
                for n in (9, 10):
                    f.write(json.dumps({"key": k, "body": json.dumps({"status": "ok", "totalResults": n}), "fetched_at": f"2026-04-08T0{n - 8}"}) + "\n")
        assert cli.main(["gather", "--responses", p, "--bronze", b, "--feed", "news", "--run-date", "2026-04-08"]) == 0
    gather(config.NEWS_KEYWORDS[:1])
    assert not any(x.startswith("ingested_at") for x in os.listdir(os.path.join(b, "news")))
    gather(config.NEWS_KEYWORDS)
    doc = json.loads(bronze.read_bronze(spark, os.path.join(b, "news")).first()["value"])
    assert {k: v["totalResults"] for k, v in doc.items()} == dict.fromkeys(config.NEWS_KEYWORDS, 10)
