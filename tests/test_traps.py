"""Remaining semantics decisions of SURVEY 2.15, one test each."""

import datetime as dt

from pyspark.sql import functions as F

from lodestone.operators import backfill, staging
from lodestone.plans import mart
from tests.test_mart import D1, D2, D3, frames


def test_t3_macro_values_are_latest_overall_on_every_trade_date(spark):
    fact = mart.build_fact(*frames(spark))
    assert {r["yield_10y"] for r in fact.collect()} == {4.5}


def test_t10_trade_date_is_the_load_day_not_the_price_timestamp(spark):
    silver = spark.createDataFrame([("2026-04-07T23:59:00Z", "gold", 1.0, "USD", "g", "2026-04-08")],
                                   "event_timestamp string, metal_symbol string, price_usd double, "
                                   "currency_base string, unit string, ingested_at string")
    r = staging.stg_metal_prices(silver).first()
    assert r["trade_date"] == dt.date(2026, 4, 8)
    assert r["event_timestamp"] == dt.datetime(2026, 4, 7, 23, 59)


def test_t15_unit_is_counted_not_filtered(spark):
    m, fx, fred, news = frames(spark)
    m2 = m.withColumn("unit", F.when(F.col("commodity_code") == "silver", "oz").otherwise(F.col("unit")))
    assert mart.build_fact(m2, fx, fred, news).count() == 4
    units = {r["unit"]: r["n"] for r in m2.groupBy("unit").agg(F.count("*").alias("n")).collect()}
    assert units == {"g": 3, "oz": 1}


def test_t18_staging_accepts_t_and_blank_separators(spark):
    silver = spark.createDataFrame([("2026-04-08T01:02:03", "n", 1, "ok", "2026-04-08"),
                                    ("2026-04-08 01:02:03", "n", 1, "ok", "2026-04-08")],
                                   "news_timestamp string, keywords string, total_mentions bigint, status string, "
                                   "ingested_at string")
    got = {r["news_timestamp"] for r in staging.stg_news_data(silver).collect()}
    assert got == {dt.datetime(2026, 4, 8, 1, 2, 3)}


def test_t20_incomplete_listing_blocks_deletion(spark):
    listing = spark.createDataFrame([("silver", "silver/2026-04-08 08:00:00/metal_prices-x.parquet", None)],
                                    "layer string, old_key string, content string")
    m = backfill.manifest(listing)
    assert backfill.summary(m).first()["ok_to_delete"] is True
    incomplete = spark.createDataFrame([("silver", False)], "layer string, listing_complete boolean")
    assert backfill.summary(m, incomplete).first()["ok_to_delete"] is False


def test_t8_t9_dates(spark):
    # fallback rate for a date without FX is the newest rate, even a later one (T-9)
    fact = mart.build_fact(*frames(spark))
    by_day = {r["trade_date"]: r["usd_to_idr"] for r in fact.where("commodity_code = 'gold'").collect()}
    assert by_day == {D1: 16000.0, D2: 16100.0, D3: 16500.0}


def test_t5_null_position_decides(spark):
    from lodestone.schemas import STAGING

    newest_null = spark.createDataFrame([("CPIAUCSL", D1, 300.0, "lin", D1), ("CPIAUCSL", D2, None, "lin", D2)],
                                        STAGING["fred"])
    oldest_null = spark.createDataFrame([("CPIAUCSL", D1, None, "lin", D1), ("CPIAUCSL", D2, 301.0, "lin", D2)],
                                        STAGING["fred"])
    assert mart.macro_pivot(newest_null).first()["cpi_index"] is None      # no "last non-null"
    assert mart.macro_pivot(oldest_null).first()["cpi_index"] == 301.0


def test_t17_a_failed_landing_write_raises(spark, tmp_dir):
    import os

    import pytest

    from lodestone.sources import bronze

    blocker = os.path.join(tmp_dir, "not_a_dir")
    with open(blocker, "w") as f:
        f.write("x")
    docs = spark.createDataFrame([("2026-04-08", '{"a": 1}')], "ingested_at string, value string")
    with pytest.raises(Exception):
        bronze.write_bronze(docs, os.path.join(blocker, "metal"))
