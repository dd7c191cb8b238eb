"""Bring the driver's synthetic tables into the four silver shapes.

The tables hold no market data, so each feed is played by a table whose
work grows with it:

* metal prices  <- lineitem: day = ship date, symbol = return flag || line
  status, price = max(extended price) per (day, symbol)
* FX rates      <- orders: rate date = order date, currency from the order
  priority (``1-URGENT`` plays IDR), rate = total price; one row per order,
  so a date with several IDR orders fans out exactly like repeated loads
* macro series  <- lineitem: series from the return flag, observation date =
  ship date, value = extended price (null where the discount is 0, playing
  the ``"."`` marker), load date = ship date + line number days (re-fetches)
* news counts   <- lineitem: mentions = quantity

Every frame is in the silver string contract, ``ingested_at`` last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions.casts import iso_seconds
from lodestone.session import spread
from lodestone.operators import staging

# Fixed values of the demo mapping.
PRIORITY_CURRENCY = (("1-URGENT", "IDR"), ("2-HIGH", "EUR"), ("3-MEDIUM", "JPY"),
                     ("4-NOT SPECIFIED", "GBP"), ("5-LOW", "USD"))
FLAG_SERIES = (("A", "DGS10"), ("N", "DTWEXBGS"), ("R", "CPIAUCSL"))
DEMO_SYMBOLS = ("AF", "AO", "NF", "NO", "RF", "RO")


def table(spark: SparkSession, sf_dir: str, name: str, per_row_heavy: bool = False) -> DataFrame:
    """A driver table. ``per_row_heavy`` marks inputs of per-row-expensive
    work (JSON, text, higher-order functions): those are spread over the cores
    when the scan is a handful of splits (``session.spread``; a no-op at
    scale). Aggregate-first inputs are not: the partial aggregate already
    shrinks them inside the scan task, and a spread would only add a shuffle."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df) if per_row_heavy else df


def _case(col: str, pairs) -> Column:
    expr = None
    for k, v in pairs:
        expr = (F.when(F.col(col) == k, F.lit(v)) if expr is None else expr.when(F.col(col) == k, F.lit(v)))
    return expr


def symbol() -> Column:
    return F.concat(F.col("l_returnflag"), F.col("l_linestatus"))


def day_text(c) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def silver_metal(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    g = li.groupBy(F.to_date("l_shipdate").alias("d"), symbol().alias("metal_symbol")).agg(
        F.max("l_extendedprice").alias("price_usd"), F.max("l_shipdate").alias("ts"))
    return g.select(iso_seconds("ts").alias("event_timestamp"), "metal_symbol", "price_usd",
                    F.lit("USD").alias("currency_base"), F.lit("g").alias("unit"),
                    day_text("d").alias("ingested_at"))


def silver_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("rate_date"),
                    _case("o_orderpriority", PRIORITY_CURRENCY).alias("currency_code"),
                    F.col("o_totalprice").alias("exchange_rate"),
                    F.lit("USD").alias("base_currency"),
                    day_text("o_orderdate").alias("ingested_at"))


def silver_fred(spark: SparkSession, sf_dir: str, per_row_heavy: bool = False) -> DataFrame:
    li = table(spark, sf_dir, "lineitem", per_row_heavy)
    return li.select(_case("l_returnflag", FLAG_SERIES).alias("series_id"),
                     iso_seconds("l_shipdate").alias("observation_date"),
                     F.when(F.col("l_discount") != 0, F.col("l_extendedprice")).alias("observation_values"),
                     F.lit("lin").alias("units"),
                     day_text(F.date_add(F.to_date("l_shipdate"), F.col("l_linenumber"))).alias("ingested_at"))


def silver_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("news_timestamp"),
                     symbol().alias("keywords"),
                     F.col("l_quantity").cast("bigint").alias("total_mentions"),
                     F.lit("ok").alias("status"),
                     day_text("l_shipdate").alias("ingested_at"))


SILVER = {"metal": silver_metal, "currency": silver_currency, "fred": silver_fred, "news": silver_news}


def staged(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    return staging.STAGERS[feed](SILVER[feed](spark, sf_dir))


def staged_all(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {feed: staged(spark, sf_dir, feed) for feed in SILVER}
