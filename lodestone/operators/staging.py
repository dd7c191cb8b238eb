"""Typed staging projections over the four silver tables (STG-1..4).

Each is a single projection: Catalyst inlines it into the consumer, prunes
unused columns down to the Parquet scan, and turns a ``trade_date`` filter
into a partition filter on ``ingested_at``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.functions.casts import date_prefix, timestamp_prefix


def stg_metal_prices(silver: DataFrame) -> DataFrame:
    return silver.select(
        date_prefix("ingested_at").alias("trade_date"),
        F.col("metal_symbol").alias("commodity_code"),
        F.col("price_usd").cast("double").alias("price_usd"),
        F.col("unit"),
        timestamp_prefix("event_timestamp").alias("event_timestamp"),
    )


def stg_currency_rates(silver: DataFrame) -> DataFrame:
    return silver.select(
        date_prefix("rate_date").alias("rate_date"),
        F.col("currency_code"),
        F.col("exchange_rate").cast("double").alias("exchange_rate"),
        F.col("base_currency"),
        date_prefix("ingested_at").alias("event_timestamp"),
    )


def stg_fred_data(silver: DataFrame) -> DataFrame:
    return silver.select(
        F.col("series_id"),
        date_prefix("observation_date").alias("observation_date"),
        F.col("observation_values").cast("double").alias("observation_values"),
        F.col("units"),
        date_prefix("ingested_at").alias("event_timestamp"),
    )


def stg_news_data(silver: DataFrame) -> DataFrame:
    return silver.select(
        timestamp_prefix("news_timestamp").alias("news_timestamp"),
        F.col("keywords").alias("topics"),
        F.col("total_mentions").cast("bigint").alias("total_mentions"),
        F.col("status"),
        date_prefix("ingested_at").alias("event_timestamp"),
    )


STAGERS = {
    "metal": stg_metal_prices,
    "currency": stg_currency_rates,
    "fred": stg_fred_data,
    "news": stg_news_data,
}
