"""Dashboard queries over the fact table (DASH-1..6).

The fact repeats a (day, commodity) price once per matching FX row (T-8),
so the price per (day, commodity) is taken with ``max`` (it is unique, and
exact); rates that really differ within a day are averaged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DAY_CODE = ("trade_date", "commodity_code")


def price_daily(fact: DataFrame) -> DataFrame:
    """DASH-1: daily metal price line per commodity."""
    return fact.groupBy(*DAY_CODE).agg(F.max("price_usd_per_gr").alias("price_usd_per_gr"))


def price_vs(fact: DataFrame, column: str) -> DataFrame:
    """DASH-2..4: price against a macro column (usd_index, yield_10y, cpi_index)."""
    return fact.groupBy(*DAY_CODE).agg(F.max("price_usd_per_gr").alias("price_usd_per_gr"),
                                       F.max(column).alias(column))


def news_price_pairs(fact: DataFrame) -> DataFrame:
    """DASH-5 series: one (mentions, price) point per (day, commodity)."""
    return fact.groupBy(*DAY_CODE).agg(F.max("news_hype_count").alias("mentions"),
                                       F.max("price_usd_per_gr").alias("price"))


def news_price_corr(fact: DataFrame) -> DataFrame:
    """DASH-5: one point per (day, commodity), then the Pearson coefficient
    between mentions and price per commodity."""
    daily = news_price_pairs(fact)
    return daily.groupBy("commodity_code").agg(
        F.corr(F.col("mentions").cast("double"), "price").alias("corr_mentions_price"),
        F.count("*").alias("n_days"))


def usd_idr(fact: DataFrame) -> DataFrame:
    """DASH-6: daily average USD/IDR plus the latest rate (newest day, highest
    rate on ties). The per-day aggregate (one row per day) is materialised
    once, so the latest-rate subquery reads it instead of the fact."""
    from lodestone.session import materialize

    daily = materialize(fact.groupBy("trade_date").agg(F.avg("usd_to_idr").alias("avg_usd_to_idr"),
                                                       F.max("usd_to_idr").alias("day_max")))
    latest = daily.agg(F.max(F.struct("trade_date", "day_max")).getField("day_max").alias("v")).scalar()
    return daily.select("trade_date", "avg_usd_to_idr", latest.alias("latest_usd_to_idr"))
