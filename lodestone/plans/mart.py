"""The daily fact table (PRJ-1..6, JOIN-1..4, AGG-1/2, WIN-1/2, SORT-1, LIM-1).

Plan shape, for a daily metal price table that is small (days x metals) and
an FX table that can be large and, for parity with the reference, is not
de-duplicated per date (so a date with several IDR rows fans out):

* metal LEFT JOIN currency_daily: the preserved side is the small one, so it
  is rewritten as broadcast-inner + anti join (no shuffle of the FX rows,
  no hot-date task); see ``preserving_join_small_left``.
* LEFT JOIN news_daily: news is pre-aggregated per (day, topic) with a
  partial hash aggregate, measured, then broadcast.
* The two one-row sides of the reference (latest IDR rate, pivoted macro
  values) are scalar subqueries: each runs once and is inlined as a value,
  so no cross join is planned. With no IDR row at all the reference's cross
  join empties the mart; ``strict=True`` keeps that via an EXISTS filter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone import config
from lodestone.operators.joins import DEFAULT_BROADCAST_ROWS, bounded, left_join_sized, preserving_join_small_left
from lodestone.operators.latest import latest_per_key, top1
from lodestone.operators.pivot import pivot_max


def currency_daily(fx: DataFrame, target: str = config.TARGET_CURRENCY, dedupe: bool = False) -> DataFrame:
    """IDR rows as (rate_date, exchange_rate) (PRJ-2, FIL-1); ``dedupe`` keeps the
    newest load per date instead of every row (avoids the T-8 fan-out)."""
    c = fx.where(F.col("currency_code") == target)
    if dedupe:
        return latest_per_key(c, ["rate_date"], ["event_timestamp"], ["exchange_rate"])
    return c.select("rate_date", "exchange_rate")


def currency_dates(fx: DataFrame, target: str = config.TARGET_CURRENCY) -> DataFrame:
    """rate_date, event_timestamp, exchange_rate of the newest load per rate date."""
    c = fx.where(F.col("currency_code") == target)
    c = c.groupBy("rate_date", "event_timestamp").agg(F.max("exchange_rate").alias("exchange_rate"))
    best = c.groupBy("rate_date").agg(F.max(F.struct("event_timestamp", "exchange_rate")).alias("b"))
    return best.select("rate_date", "b.event_timestamp", "b.exchange_rate")


def currency_latest(fx: DataFrame, target: str = config.TARGET_CURRENCY) -> DataFrame:
    """The newest IDR rate, at most one row (PRJ-3, SORT-1, LIM-1)."""
    c = fx.where(F.col("currency_code") == target)
    return top1(c, ["rate_date", "event_timestamp"], ["exchange_rate"]).select(
        F.col("exchange_rate").alias("latest_rate"))


def news_daily(news: DataFrame) -> DataFrame:
    """sum(total_mentions) per (news_date, topics) (AGG-1, PRJ-4)."""
    return news.groupBy(F.col("event_timestamp").alias("news_date"), F.col("topics")).agg(
        F.sum("total_mentions").cast("bigint").alias("daily_mentions"))


def macro_latest(fred: DataFrame, series=config.FRED_SERIES, method: str = "aggregate") -> DataFrame:
    """Newest observation per configured series (WIN-2). The ``IN`` filter is the
    predicate implied by the pivot's CASE arms, written out so it reaches the scan."""
    f = fred.where(F.col("series_id").isin(list(series)))
    return latest_per_key(f, ["series_id"], ["observation_date", "event_timestamp"], ["observation_values"],
                          method=method)


def macro_pivot(fred: DataFrame, method: str = "aggregate") -> DataFrame:
    """One row: yield_10y, usd_index, cpi_index (AGG-2)."""
    return pivot_max(macro_latest(fred, method=method), "series_id", "observation_values", config.MACRO_COLUMNS)


def build_fact(metal: DataFrame, fx: DataFrame, fred: DataFrame, news: DataFrame, *,
               target: str = config.TARGET_CURRENCY, strict: bool = True, dedupe_rates: bool = False,
               max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Four staged frames -> the nine-column fact (PRJ-6)."""
    m, m_small = bounded(metal.select("trade_date", "commodity_code", "price_usd"), max_broadcast_rows)
    # One row per rate date: newest rate, the dates themselves and whether there
    # is any rate at all come from here, so FX is read once more at most.
    dates, _ = bounded(currency_dates(fx, target), max_broadcast_rows)
    daily = dates.select("rate_date", "exchange_rate")
    rated = preserving_join_small_left(m, daily if dedupe_rates else currency_daily(fx, target),
                                       on=[("trade_date", "rate_date")], big_columns=["exchange_rate"],
                                       small_ok=m_small, keys=daily)
    n, n_small = bounded(news_daily(news), max_broadcast_rows)
    joined = left_join_sized(rated, n, [("trade_date", "news_date"), ("commodity_code", "topics")], n_small)

    # One scalar subquery carries every one-row value: the newest IDR rate
    # (null when there is none) and the three macro columns.
    latest = top1(dates, ["rate_date", "event_timestamp"], ["exchange_rate"]).select(
        F.col("exchange_rate").alias("latest_rate"))
    macro_cols = [c for _, c in config.MACRO_COLUMNS]
    params = macro_pivot(fred).select(
        F.struct(latest.scalar().alias("latest_rate"), *macro_cols).alias("p")).scalar()
    # Referenced once, then read through the alias, so it is planned once.
    with_params = joined.select("commodity_code", "price_usd", "trade_date", "daily_mentions",
                                "exchange_rate", params.alias("p"))
    rated_row = with_params.select(
        "commodity_code", "price_usd", "trade_date", "daily_mentions", "p",
        F.coalesce(F.col("exchange_rate"), F.col("p").getField("latest_rate")).alias("usd_to_idr"))
    fact = rated_row.select(
        F.col("commodity_code"),
        F.col("price_usd").alias("price_usd_per_gr"),
        F.col("usd_to_idr"),
        (F.col("price_usd") * F.col("usd_to_idr")).alias("price_idr_per_gr"),
        F.coalesce(F.col("daily_mentions"), F.lit(0).cast("bigint")).alias("news_hype_count"),
        *[F.col("p").getField(c).alias(c) for c in macro_cols],
        F.col("trade_date"),
    )
    if not strict:
        return fact
    # The reference cross-joins the latest-rate row: no IDR row, no fact rows.
    has_rate = dates.select(F.lit(1).alias("one")).limit(1)
    return fact.where(has_rate.exists())
