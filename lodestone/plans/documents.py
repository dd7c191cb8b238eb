"""Bronze documents built from the synthetic tables (the wire form of each feed).

Documents are kept small by construction: metal, FX and news documents are
one per day over a fixed symbol set, pre-aggregated per (day, symbol) before
the per-day grouping, so a document never holds more entries than the set;
the macro feed is one document per line item. Bad values are injected by
day of month so every validation rule has work at every scale:

* metal: day 13 negative price, day 29 price null, day 31 status "error"
* FX: day 7 unparseable date, day 13 rate "0", day 29 rate "n/a"; the four
  configured currencies without a playing priority are missing
* macro: discount 0 -> ".", else tax 0 -> negative value
* news: day 13 status "error", day 29 no totalResults, day 30 totalResults null
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.plans.demo import FLAG_SERIES, PRIORITY_CURRENCY, _case, day_text, symbol, table



def _dom():
    return F.dayofmonth("d")


def _doc(cols) -> F.Column:
    return F.to_json(F.struct(*cols))


def metal_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    per = li.groupBy(F.to_date("l_shipdate").alias("d"), symbol().alias("sym")).agg(
        F.max("l_extendedprice").alias("price"), F.max("l_shipdate").alias("ts"))
    per = per.withColumn("price", F.when(_dom() == 13, -F.col("price")).when(_dom() == 29, F.lit(None)).otherwise(F.col("price")))
    day = per.groupBy("d").agg(F.map_from_entries(F.collect_list(F.struct("sym", "price"))).alias("metals"),
                               F.max("ts").alias("ts"))
    return day.select(day_text("d").alias("ingested_at"), _doc([
        F.when(_dom() == 31, F.lit("error")).otherwise(F.lit("success")).alias("status"),
        F.lit("USD").alias("currency"), F.lit("g").alias("unit"), F.col("metals"),
        F.create_map(F.lit("metal"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("timestamps"),
    ]).alias("value"))


def currency_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    per = o.groupBy(F.to_date("o_orderdate").alias("d"), _case("o_orderpriority", PRIORITY_CURRENCY).alias("code")).agg(
        F.max("o_totalprice").alias("rate"))
    text = (F.when(_dom() == 13, F.lit("0")).when(_dom() == 29, F.lit("n/a"))
            .otherwise(F.col("rate").cast("string")))
    day = per.groupBy("d").agg(F.map_from_entries(F.collect_list(F.struct("code", text))).alias("rates"))
    date_text = F.when(_dom() == 7, F.lit("someday")).otherwise(
        F.concat(F.date_format("d", "yyyy-MM-dd HH:mm:ss"), F.lit("+00")))
    return day.select(day_text("d").alias("ingested_at"),
                      _doc([date_text.alias("date"), F.lit("USD").alias("base"), F.col("rates")]).alias("value"))


def fred_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem", per_row_heavy=True)
    price = F.col("l_extendedprice").cast("string")
    value = (F.when(F.col("l_discount") == 0, F.lit(".")).when(F.col("l_tax") == 0, F.concat(F.lit("-"), price))
             .otherwise(price))
    obs = F.struct(F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"), value.alias("value"))
    series = F.struct(F.lit("lin").alias("units"), F.array(obs).alias("observations"))
    return li.select(day_text(F.date_add(F.to_date("l_shipdate"), F.col("l_linenumber"))).alias("ingested_at"),
                     F.to_json(F.create_map(_case("l_returnflag", FLAG_SERIES), series)).alias("value"))


def news_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    per = li.groupBy(F.to_date("l_shipdate").alias("d"), symbol().alias("sym")).agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("total"))
    status = F.when(_dom() == 13, F.lit("error")).otherwise(F.lit("ok"))
    total = F.when(_dom() == 30, F.lit(None).cast("string")).otherwise(F.col("total").cast("string"))
    inner = F.when(_dom() == 29, F.create_map(F.lit("status"), status)).otherwise(
        F.create_map(F.lit("status"), status, F.lit("totalResults"), total))
    day = per.groupBy("d").agg(F.map_from_entries(F.collect_list(F.struct("sym", inner))).alias("m"))
    return day.select(day_text("d").alias("ingested_at"), F.to_json("m").alias("value"))


DOCS = {"metal": metal_docs, "currency": currency_docs, "fred": fred_docs, "news": news_docs}


# Fixed values of the demo listing: file name per order priority ("misc" is a
# feed the back-fill cannot classify).
PRIORITY_FILE = (("1-URGENT", "metal_prices"), ("2-HIGH", "currency_rates"), ("3-MEDIUM", "fred_data"),
                 ("4-NOT SPECIFIED", "news_data"), ("5-LOW", "misc_feed"))
PRIORITY_FEED = (("1-URGENT", "metal"), ("2-HIGH", "currency"), ("3-MEDIUM", "fred"),
                 ("4-NOT SPECIFIED", "news"), ("5-LOW", "misc"))
SMALL_ORDER = 20000


def backfill_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An old-layout object listing played by orders: one object per order.
    Finished orders are silver objects, the rest bronze; pending orders are
    already in the new layout; small orders are a CSV in silver and broken
    JSON in bronze. Many orders share a (feed, day), so the last-write-wins
    rule decides between them."""
    o = table(spark, sf_dir, "orders", per_row_heavy=True)
    layer = F.when(F.col("o_orderstatus") == "F", F.lit("silver")).otherwise(F.lit("bronze"))
    ts = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    small = F.col("o_totalprice") < SMALL_ORDER
    ext = (F.when(layer == "silver", F.when(small, F.lit(".csv")).otherwise(F.lit(".parquet")))
           .otherwise(F.lit(".json")))
    old = F.concat(layer, F.lit("/"), ts, F.lit("/"), _case("o_orderpriority", PRIORITY_FILE), F.lit("-"), ts,
                   F.lit("-"), F.col("o_orderkey").cast("string"), ext)
    new = F.concat(layer, F.lit("/"), _case("o_orderpriority", PRIORITY_FEED), F.lit("/ingested_at="),
                   F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("/data"), ext)
    key = F.when(F.col("o_orderstatus") == "P", new).otherwise(old)
    content = F.when(layer == "bronze", F.when(small, F.lit("{broken")).otherwise(
        F.to_json(F.struct("o_orderkey", "o_totalprice"))))
    return o.select(layer.alias("layer"), key.alias("old_key"), content.alias("content"))


# --- rows and documents with a fault in every so many, for every rule -------------

def _n() -> F.Column:
    return F.col("l_orderkey") * 8 + F.col("l_linenumber")


def _unless(every: int, bad, good) -> F.Column:
    """``bad`` on every so many rows, else ``good``."""
    return F.when(_n() % every == 0, bad).otherwise(good)


def raw_metal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem", per_row_heavy=True).select(
        _unless(11, F.lit("soon"), F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("event_timestamp"),
        _unless(13, F.lit(""), symbol()).alias("metal_symbol"), _unless(17, F.lit("-1"), F.col("l_extendedprice").cast("string")).alias("price_usd"),
        _unless(19, F.lit(None), F.lit("USD")).alias("currency_base"), F.lit("g").alias("unit"), day_text("l_shipdate").alias("ingested_at"))


def raw_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem", per_row_heavy=True).select(
        _unless(11, F.lit("someday"), F.concat(F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"), F.lit(" +utc"))).alias("rate_date"),
        _unless(13, F.lit(None), symbol()).alias("currency_code"), _unless(17, F.lit("n/a"), F.lit("2.5")).alias("exchange_rate"),
        _unless(19, F.lit(None), F.lit("USD")).alias("base_currency"), day_text("l_shipdate").alias("ingested_at"))


def raw_fred(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem", per_row_heavy=True).select(
        _unless(13, F.lit(None), symbol()).alias("series_id"), _unless(11, F.lit("2026-02-30"), day_text("l_shipdate")).alias("observation_date"),
        _unless(17, F.lit("x"), _unless(7, F.lit("."), F.lit("1.5"))).alias("observation_values"), F.lit("lin").alias("units"),
        day_text("l_shipdate").alias("ingested_at"))


def raw_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem", per_row_heavy=True).select(
        day_text("l_shipdate").alias("news_timestamp"), _unless(13, F.lit(None), symbol()).alias("keywords"),
        _unless(17, F.lit("-3"), F.lit("4.0")).alias("total_mentions"), _unless(19, F.lit("error"), F.lit("ok")).alias("status"),
        day_text("l_shipdate").alias("ingested_at"))


RAW = {"metal": raw_metal, "currency": raw_currency, "fred": raw_fred, "news": raw_news}


# Spellings of an instant, as the pattern that writes it and what is left of the time: day, minute, second.
SPELLINGS = (
    ("yyyy-MM-dd", "day"), ("yyyy-MM-dd'T'HH:mm:ss'Z'", "second"), ("yyyy/MM/dd", "day"), ("M/d/yyyy", "day"), ("yyyyMMdd", "day"),
    ("MMM d, yyyy", "day"), ("MMMM d, yyyy HH:mm", "minute"), ("d MMM yyyy", "day"), ("d MMMM yyyy HH:mm:ss", "second"),
    ("EEE MMM d HH:mm:ss yyyy", "second"), ("EEE, d MMM yyyy HH:mm:ss 'GMT'", "second"), ("EEEE, MMMM d, yyyy", "day"), ("d-MMM-yyyy", "day"),
    ("d-MMM-yy", "day"), ("dd.MMM.yyyy", "day"), ("yyyy MMM d", "day"), ("yyyy.MM.dd HH:mm", "minute"), ("M-d-yyyy HH:mm", "minute"), ("M/d/yy", "day"),
    ("yyyyMMddHHmmss", "second"), ("yyyyMMddHHmm", "minute"), ("yyyyMMdd'T'HH:mm:ss", "second"), ("h:mm a, MMMM d, yyyy", "minute"), ("MMM d yyyy h:mm:ss a", "second"),
    ("HH:mm:ss d MMM yyyy", "second"), ("'on' MMMM d'th' yyyy 'at' HH:mm 'UTC'", "minute"), ("yyyy-MM-dd HH:mm:ss '+0000'", "second"),
    ("yyyy-M-d H:mm", "minute"), ("MMM/d/yyyy", "day"), ("dMMMyyyy", "day"), ("d 'of' MMMM yyyy", "day"), ("yyyy-MM-dd HH:mm:ss.SSS", "second"))


def spelled_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """o_orderkey and its order date in one of SPELLINGS."""
    o = table(spark, sf_dir, "orders", per_row_heavy=True)
    spelled = F.coalesce(*[F.when(F.col("o_orderkey") % len(SPELLINGS) == i, F.date_format("o_orderdate", f)) for i, (f, _) in enumerate(SPELLINGS)])
    return o.select("o_orderkey", spelled.alias("spelled"))


def faulty_fred_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Macro documents, one per line item, some empty, broken or without content."""
    li = table(spark, sf_dir, "lineitem", per_row_heavy=True)
    series = F.create_map(_case("l_returnflag", FLAG_SERIES), F.struct(F.lit("lin").alias("units")))
    value = _unless(11, F.lit("  "), _unless(13, F.lit("{broken"), _unless(17, F.lit("{}"), F.to_json(series))))
    return li.select(day_text("l_shipdate").alias("ingested_at"), value.alias("value"))
