"""Registered queries of the jobs that move and land files: each writes a tree
below the shared folder from the driver's tables, runs the job over it and
returns what the job reports or left."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lodestone import config
from lodestone.functions.casts import iso_seconds
from lodestone.operators import backfill, envelope, validate
from lodestone.plans import daily, demo, documents, oldtree, retention
from lodestone.plans.catalog import register
from lodestone.plans.oracle import _RULES, CTE, _case, with_
from lodestone.plans.queries import stored_mart
from lodestone.session import shared_path
from lodestone.sources import bronze, inventory, silver
from lodestone.streaming import landing

# --- back-fill proven per file (MIG-6, MIG-7) --------------------------------

BACKFILL_RECONCILED = f"""
WITH y AS (SELECT CAST(year(o_orderdate) AS BIGINT) AS y, count(*) AS n FROM orders GROUP BY ALL)
SELECT 'silver' AS layer, 'currency' AS feed, y || '-01-01' AS ingest_day,
  CASE WHEN y = {oldtree.DAMAGED_YEAR} THEN 'failed' ELSE 'migrated' END AS outcome, n AS n_expected,
  CASE WHEN y <> {oldtree.DAMAGED_YEAR} THEN n END AS n_written, false AS ok_to_delete FROM y
UNION ALL
SELECT 'bronze', 'metal', y || '-01-01', 'migrated', 1, 1, true FROM y
"""


@register("backfill_reconciled", BACKFILL_RECONCILED)
def q_backfill_reconciled(spark, sf):
    """Old objects moved into day folders, with each winner's rows by its footer
    and as they stand in the new folder. One FX file is damaged half way, and its day stands
    in the target from an earlier run: it must not pass for moved."""
    root, out = shared_path(spark, "old-layout"), shared_path(spark, "new-layout")
    oldtree.write_old_tree(spark, sf, root)
    demo.silver_currency(spark, sf).where(F.year("ingested_at") == oldtree.DAMAGED_YEAR).drop("ingested_at") \
        .write.parquet(f"{out}/silver/currency/{backfill.PARTITION}={oldtree.DAMAGED_YEAR}-01-01")
    man, ledger = backfill.backfill_ledger(spark, root, out)
    gate = backfill.summary(man, backfill.listing_complete(spark, root, man)).select("layer", "ok_to_delete")
    return man.join(ledger, ["layer", "feed", "ingest_day"], "left").join(F.broadcast(gate), "layer") \
        .select("layer", "feed", "ingest_day", "outcome", "n_expected", "n_written", "ok_to_delete")


# --- partitions computed from the calendar (SRC-8) -----------------------------

FROM, TO = "1996-02-20", "1996-04-10"


@register("computed_partitions", with_(extra={"s": CTE["silver_currency"]}) + f"""
SELECT ingested_at, currency_code, CAST(count(*) AS BIGINT) AS n_rows, max(exchange_rate) AS highest FROM silver_currency
WHERE ingested_at BETWEEN '{FROM}' AND '{TO}' AND ingested_at NOT LIKE '%-03-1%' GROUP BY ALL""")
def q_computed_partitions(spark, sf):
    """A window of days of a day-partitioned table by computed folders. Some days
    have no folder; beside the days lie folders that a listing would stumble over."""
    path = shared_path(spark, "silver-days")
    rates = demo.silver_currency(spark, sf)
    silver.write_silver(rates.where(~F.col("ingested_at").like("%-03-1%")), path, "currency")
    for stray in (f"{path}/ingested_at=notes", f"{path}/ingested_at=1890-01-01/hour=3", f"{path}/tmp"):
        rates.select(F.to_json(F.struct("*"))).where("false").write.text(stray)
    return silver.read_days(spark, path, "currency", FROM, TO).groupBy("ingested_at", "currency_code").agg(
        F.count("*").alias("n_rows"), F.max("exchange_rate").alias("highest"))


# --- listing of an object tree in tasks (MIG-1) ----------------------------------

LATE_YEAR = 1995


@register("inventory_listing", f"""
SELECT 'orders/y=' || year(o_orderdate) || '/m=' || month(o_orderdate) AS prefix, CASE WHEN year(o_orderdate) = {LATE_YEAR} THEN 2 ELSE 1 END AS n_objects,
  year(o_orderdate) = {LATE_YEAR} AS listed_again FROM orders GROUP BY year(o_orderdate), month(o_orderdate)""")
def q_inventory(spark, sf):
    """A tree of a folder per order month is listed; then objects come into the
    months of one year, and the inventory is brought up to date: only prefixes that
    changed are listed again."""
    root = shared_path(spark, "tree")
    orders = demo.table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"))
    one_each = lambda df: df.repartition("y", "m").write.partitionBy("y", "m").mode("append").parquet(f"{root}/orders")
    one_each(orders)
    first = inventory.inventory(spark, root)
    one_each(orders.where(F.col("y") == LATE_YEAR))
    now = inventory.inventory(spark, root, previous=first).where("NOT is_dir AND path LIKE '%.parquet'")
    prefix = F.substring("parent", F.lit(len(inventory.store(root)[1]) + 2), F.length("parent"))
    return now.groupBy(prefix.alias("prefix")).agg(F.count("*").alias("n_objects"), F.max("listed").alias("listed_again"))


# --- landing by document, as a stream with state (SRC-14, SRC-15) --------------------


def monthly_documents(spark, sf):
    """One macro document per line item, loaded on the first of its ship month; ``part`` tells its delivery."""
    li = demo.table(spark, sf, "lineitem", per_row_heavy=True)
    body = F.struct(F.lit("lin").alias("units"), F.array(F.struct(demo.day_text("l_shipdate").alias("date"), F.col("l_extendedprice").cast("string").alias("value"))).alias("observations"),
                    F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"))
    return li.select(F.to_json(F.create_map(demo._case("l_returnflag", demo.FLAG_SERIES), body)).alias("value"),
                     demo.day_text(F.trunc("l_shipdate", "MM")).alias("ingested_at"), (F.col("l_linenumber") % 3).alias("part"))


@register("landing_stream", f"""
SELECT {_case('l_returnflag', demo.FLAG_SERIES)} AS series_id, strftime(date_trunc('month', l_shipdate), '%Y-%m-%d') AS ingested_at,
  CAST(count(*) AS BIGINT) AS n_rows, max(l_extendedprice) AS highest, CAST(count(DISTINCT l_linenumber % 3) AS BIGINT) AS n_batches
FROM lineitem GROUP BY ALL""")
def q_landing_stream(spark, sf):
    """Macro documents land in three triggers of a stream; the second and the
    third also find files with documents of the first again. Every row is there once."""
    root = shared_path(spark, "landing")
    docs = monthly_documents(spark, sf)
    for part in range(3):
        again = F.lit(False) if part == 0 else F.month("ingested_at") % 3 == part
        docs.where((F.col("part") == part) | ((F.col("part") == 0) & again)).select("value", "ingested_at") \
            .hint("rebalance", "ingested_at").write.mode("append").partitionBy("ingested_at").text(f"{root}/bronze/fred")
        landing.start_document_landing(spark, f"{root}/bronze", f"{root}/silver", "fred", f"{root}/checkpoint", complete=False).awaitTermination()
    rows = spark.read.parquet(f"{root}/silver/fred").select("series_id", F.col("ingested_at").cast("string").alias("ingested_at"), "observation_values", landing.BATCH)
    return rows.groupBy("series_id", "ingested_at").agg(F.count("*").alias("n_rows"), F.max("observation_values").alias("highest"),
                                                        F.countDistinct(landing.BATCH).alias("n_batches"))


# --- mart builds that expire while others are read (SRC-12) ---------------------------


@register("mart_retention", with_("fact") + """
SELECT year(trade_date) AS y, CAST(count(*) AS BIGINT) AS n_rows, max(price_usd_per_gr) AS highest, 2 AS n_builds
FROM fact WHERE year(trade_date) IN (1995, 1996) GROUP BY year(trade_date)""")
def q_mart_retention(spark, sf):
    """Three builds of a mart of two years; the first is superseded and free, the second is being
    read, so after the expiry it and the newest are there. The rows are the newest's."""
    path = shared_path(spark, "expiring-mart")
    mart = stored_mart(spark, sf)
    for years in ((1993,), (1994,), (1995, 1996)):
        if years == (1995, 1996):
            retention.open_mart(spark, path, lease=dt.timedelta(days=30))  # of the second build
        daily.write_mart(mart.where(F.year("trade_date").isin(list(years))), path)
    retention.expire_builds(spark, path, now=dt.datetime.now(dt.UTC) + dt.timedelta(days=10))
    n_builds = sum(s.is_dir for s in inventory.inventory(spark, path).where("is_dir AND path LIKE '%/build-%' AND path NOT LIKE '%/build-%/%'").toLocalIterator())
    rows, _ = retention.open_mart(spark, path)
    return rows.groupBy(F.year("trade_date").alias("y")).agg(F.count("*").alias("n_rows"), F.max("price_usd_per_gr").alias("highest"), F.lit(n_builds).alias("n_builds"))


# --- counters of a landing as data (FLT-7, FLT-9) -------------------------------------


def _any_rule(feed):
    return " OR ".join(f"n % {k} = 0" for k in sorted({k for f, _, k in _RULES if f == feed}))


@register("landing_counters", "WITH n AS (SELECT l_orderkey * 8 + l_linenumber AS n FROM lineitem) " + " UNION ALL ".join(
    f"SELECT '{feed}' AS feed, CAST(count(*) FILTER (WHERE NOT ({_any_rule(feed)})) AS BIGINT) AS accepted, "
    f"CAST(count(*) FILTER (WHERE {_any_rule(feed)}) AS BIGINT) AS rejected, false AS wrote_nothing FROM n" for feed in ("metal", "fred", "news"))
    + f" UNION ALL SELECT 'currency', 0, CAST(count(*) FILTER (WHERE {_any_rule('currency')}) AS BIGINT), true FROM n")
def q_landing_counters(spark, sf):
    """Rows of four feeds, some faulty, landed by month; of the FX rows only faulty ones come, so that feed writes nothing."""
    checked = {}
    for feed, raw in documents.RAW.items():
        by_month = raw(spark, sf).withColumn("ingested_at", F.concat(F.substring("ingested_at", 1, 7), F.lit("-01")))
        checked[feed] = validate.check(by_month, feed)
    checked["currency"] = checked["currency"].where(F.size("reject_reasons") > 0)
    return daily.land_feeds(checked, shared_path(spark, "counted"))


# --- run date and load instant as arguments; empty keys (ENV-3, ENV-8, VAL-15, FN-12) ----

RUN_DATE, LOADED_AT = "2026-04-08", "2026-04-08 16:00:01"


@register("stamped_documents", f"SELECT '{RUN_DATE}' AS ingested_at, " + ", ".join(
    f"arg_max(l_extendedprice, l_orderkey * 8 + l_linenumber) FILTER (WHERE {_case('l_returnflag', demo.FLAG_SERIES)} = '{s}') AS {s.lower()}"
    for s in config.FRED_SERIES) + " FROM lineitem")
def q_stamped_documents(spark, sf):
    """The newest response of each series becomes the document of a given run date (ENV-8); empty entries of the series list are skipped (ENV-3)."""
    li = demo.table(spark, sf, "lineitem")
    resp = li.select(demo._case("l_returnflag", demo.FLAG_SERIES).alias("key"), F.to_json(F.struct(F.col("l_extendedprice").alias("v"))).alias("body"),
                     (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("at"))
    domain = [x for s in config.FRED_SERIES for x in (s, "")]
    docs = bronze.gather_responses(envelope.stamp_load_date(resp, RUN_DATE), domain, fetched_col="at")
    m = F.from_json("value", "map<string,struct<v:double>>")
    return docs.select("ingested_at", m.alias("m")).select("ingested_at", *[F.col("m")[s]["v"].alias(s.lower()) for s in config.FRED_SERIES])


@register("stamped_rows", f"""
WITH n AS (SELECT l_orderkey * 8 + l_linenumber AS n FROM lineitem)
SELECT '{RUN_DATE}' AS ingested_at, TIMESTAMP '{LOADED_AT}' AS loaded_at, '{LOADED_AT.replace(" ", "T")}' AS loaded_text, CAST(count(*) AS BIGINT) AS n_rows
FROM n WHERE NOT ({_any_rule("news")})""")
def q_stamped_rows(spark, sf):
    """Valid news rows written under a given run date with a given load instant (VAL-15), read back with the instant as text (FN-12)."""
    path = shared_path(spark, "stamped")
    valid, _ = validate.split(validate.check(envelope.stamp_load_date(documents.RAW["news"](spark, sf), RUN_DATE), "news"))
    silver.write_silver(valid.withColumn("loaded_at", F.lit(LOADED_AT).cast("timestamp")), path, "news")
    rows = silver.read_days(spark, path, "news", RUN_DATE, RUN_DATE)
    return rows.groupBy("ingested_at", F.col("loaded_at").cast("timestamp_ntz").alias("loaded_at"), iso_seconds("loaded_at").alias("loaded_text")) \
        .agg(F.count("*").alias("n_rows"))
