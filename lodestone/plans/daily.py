"""The daily jobs, end to end (section 3.1 and 3.2 of the survey).

``land_to_silver``: one feed, one run date: bronze day -> envelope -> flatten
-> validate -> silver day partition (replaced on re-run) + reject table.
``build_mart``: silver tables -> staging -> fact -> mart table partitioned by
trade date (full rebuild, SRC-12).
"""

from __future__ import annotations

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lodestone import config, schemas
from lodestone.operators import envelope, flatten, staging, validate
from lodestone.plans import mart
from lodestone.session import materialize
from lodestone.sources import bronze, silver


def flatten_checked(docs: DataFrame, feed: str, run_ts: str | None = None, on_missing: str = "skip") -> DataFrame:
    """Documents (with their envelope, see ``checked_documents``) -> typed rows
    with ``reject_reasons`` (nothing dropped)."""
    if "envelope_error" not in docs.columns:
        docs = envelope.check_envelope(docs, feed)
    accepted = docs.withColumn("accepted", F.col("envelope_error").isNull()).drop("envelope_error")
    if feed == "news":
        raw = flatten.flatten_news(accepted, news_timestamp=run_ts)
    elif feed == "currency":
        raw = flatten.flatten_currency(accepted, on_missing=on_missing)
    else:
        raw = flatten.FLATTENERS[feed](accepted)
    return validate.check(raw, feed)


COUNTERS = "feed string, accepted bigint, rejected bigint, wrote_nothing boolean"


def write_counted(checked: DataFrame, path: str, feed: str) -> tuple[str, int, int, bool]:
    """FLT-7, FLT-9: write the valid rows of ``checked`` and return their count
    and that of the rejected ones, and whether nothing was written. Both are
    observed while the write reads the rows; no second job counts them. (Should an executor be
    lost, a task that runs again is observed again, as with any Spark metric.)

    The rows are rebalanced before they are observed, so that the metric is
    part of the last stage, which stays when no row is valid. Without any
    row Spark leaves the stage and its metric out: that is a count of zero."""
    ok = F.size("reject_reasons") == 0
    seen = Observation(f"{feed}-{uuid.uuid4().hex[:8]}")
    watched = checked.hint("rebalance", schemas.PARTITION_COLUMN) \
        .observe(seen, F.count_if(ok).alias("accepted"), F.count_if(~ok).alias("rejected"))
    silver.write_silver(watched.where(ok).drop("reject_reasons"), path, feed, balance=False)
    try:
        accepted, rejected = seen.get["accepted"], seen.get["rejected"]
    except Py4JJavaError:
        accepted = rejected = 0
    return feed, accepted, rejected, accepted == 0


def land_feeds(checked: dict[str, DataFrame], silver_root: str) -> DataFrame:
    """Write the valid rows of several feeds and return one row of COUNTERS for each."""
    rows = [write_counted(df, os.path.join(silver_root, feed), feed) for feed, df in checked.items()]
    return next(iter(checked.values())).sparkSession.createDataFrame(rows, COUNTERS)


def land_documents(docs: DataFrame, silver_root: str, feed: str, days: list[str], run_ts: str | None = None,
                   on_missing: str = "fail", complete: bool = True) -> dict:
    """Write the silver rows and the rejects of whole days of documents.

    A reject has a ``level``: ``document`` (its envelope failed; ``document``
    holds the text and ``reject_reasons`` the error) or ``row``. Each day's
    reject folder is replaced, also by nothing, so a repaired day keeps none.
    Days are the caller's list (one for a daily run)."""
    checked = materialize(envelope.check_envelope(docs, feed, complete=complete).drop("top"))
    refused = checked.where(F.col("envelope_error").isNotNull()).select(
        F.lit("document").alias("level"), F.col("envelope_error").alias("reject_reasons"), F.col("value").alias("document"), "ingested_at")
    good = envelope.check_envelope(checked.where(F.col("envelope_error").isNull()).drop("envelope_error"), feed, complete=complete)
    rows = materialize(flatten_checked(good, feed, run_ts, on_missing))
    _, rejected = validate.split(rows)
    _, n_accepted, n_rejected, _ = write_counted(rows, os.path.join(silver_root, feed), feed)
    rejects = rejected.withColumn("level", F.lit("row")).withColumn("reject_reasons", F.array_join("reject_reasons", ",")) \
        .unionByName(refused, allowMissingColumns=True)
    for day in days:
        (rejects.where(F.col("ingested_at") == day).drop("ingested_at").write.mode("overwrite")
         .option("partitionOverwriteMode", "static").parquet(os.path.join(silver_root, "_rejects", feed, f"ingested_at={day}")))
    return {"accepted": n_accepted, "rejected": n_rejected + refused.count()}


def land_to_silver(spark: SparkSession, bronze_root: str, silver_root: str, feed: str, run_date: str,
                   run_ts: str | None = None, whole_text: bool = False, on_missing: str = "fail",
                   complete: bool = True) -> dict:
    """Returns the accepted and rejected counts (rows, and documents refused
    whole). Bronze files are NDJSON (one document per line, as
    ``write_bronze`` writes them); ``whole_text`` reads each file as one
    (pretty-printed) document. ``on_missing`` decides about an FX document
    without a configured currency: ``fail`` (T-4) or ``skip``. With
    ``complete`` a macro or news document must hold every configured key."""
    docs = bronze.read_bronze(spark, os.path.join(bronze_root, feed), days=[run_date], whole_text=whole_text)
    return land_documents(docs, silver_root, feed, [run_date], run_ts, on_missing, complete)


def land_responses(responses: DataFrame, bronze_root: str, feed: str, run_date: str) -> None:
    """SRC-16/17: the day's per-series or per-keyword responses (key, body,
    fetched_at) become one bronze document of the run date, the newest fetch
    of each key; nothing is written while a configured key is missing."""
    domain = config.FRED_SERIES if feed == "fred" else config.NEWS_KEYWORDS
    docs = bronze.gather_responses(envelope.stamp_load_date(responses, run_date), domain, fetched_col="fetched_at")
    bronze.write_bronze(docs, os.path.join(bronze_root, feed))


def staged_from_silver(spark: SparkSession, silver_root: str, run_date: str,
                       start: str = config.PROJECTION_START) -> dict[str, DataFrame]:
    out = {}
    for feed in config.FEEDS:
        out[feed] = staging.STAGERS[feed](silver.read_days(spark, os.path.join(silver_root, feed), feed, start, run_date))
    return out


BUILDS = "built_at timestamp, build string"


def write_mart(fact: DataFrame, path: str) -> str:
    """SRC-12: full rebuild, Parquet, partitioned by trade date (rebalanced on
    the day: small days coalesce, a hot day is split over several tasks).

    Each build is a folder of its own below ``path`` and counts from the
    moment its row stands in ``path/builds``, the last step. So a build that
    fails leaves the mart as it was, and readers of the one before are not
    disturbed. Returns the folder; earlier builds stay until someone removes them."""
    folder = f"build-{uuid.uuid4().hex[:12]}"
    fact.hint("rebalance", "trade_date").write.partitionBy("trade_date").parquet(os.path.join(path, folder))
    done = fact.sparkSession.range(1).select(F.current_timestamp().alias("built_at"), F.lit(folder).alias("build"))
    done.coalesce(1).write.mode("append").parquet(os.path.join(path, "builds"))
    return os.path.join(path, folder)


def build_mart(spark: SparkSession, silver_root: str, mart_path: str, run_date: str,
               start: str = config.PROJECTION_START, **kw) -> str:
    s = staged_from_silver(spark, silver_root, run_date, start)
    return write_mart(mart.build_fact(s["metal"], s["currency"], s["fred"], s["news"], **kw), mart_path)


def current_build(spark: SparkSession, path: str) -> str:
    """The folder of the newest complete build, for readers that want a path."""
    builds = spark.read.schema(BUILDS).parquet(os.path.join(path, "builds"))
    return os.path.join(path, builds.orderBy(F.col("built_at").desc(), "build").first()["build"])


def read_fact(spark: SparkSession, folder: str) -> DataFrame:
    """One written fact table, with the fixed schema and column order."""
    cols = schemas.column_names(schemas.FACT)
    return spark.read.schema(schemas.struct(schemas.FACT)).parquet(folder).select(*cols)


def read_mart(spark: SparkSession, path: str) -> DataFrame:
    return read_fact(spark, current_build(spark, path))
