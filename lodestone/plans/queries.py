"""Registered queries over the driver's tables (see SURVEY section 7.6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestone.plans import demo, mart
from lodestone.plans.catalog import register
from lodestone.plans.oracle import with_

# --- staging (STG-1..4) ----------------------------------------------------
for _feed, _name in (("metal", "stg_metal_prices"), ("currency", "stg_currency_rates"),
                     ("fred", "stg_fred_data"), ("news", "stg_news_data")):
    register(_name, with_(_name) + f"SELECT * FROM {_name}")(
        (lambda feed: lambda spark, sf: demo.staged(spark, sf, feed))(_feed))


# --- mart (PRJ-6 and parts) ---------------------------------------------------
def fact(spark, sf, **kw):
    s = demo.staged_all(spark, sf)
    return mart.build_fact(s["metal"], s["currency"], s["fred"], s["news"], **kw)


@register("fact_commodity_performance", with_("fact") + "SELECT * FROM fact")
def q_fact(spark, sf):
    return fact(spark, sf)


@register("fact_dedup_rates", with_("fact_dedup") + "SELECT * FROM fact_dedup")
def q_fact_dedup(spark, sf):
    return fact(spark, sf, dedupe_rates=True)


@register("currency_daily", with_("currency_daily") + "SELECT * FROM currency_daily")
def q_currency_daily(spark, sf):
    return mart.currency_daily(demo.staged(spark, sf, "currency"))


@register("currency_daily_dedup", with_("currency_daily_dedup") + "SELECT * FROM currency_daily_dedup")
def q_currency_daily_dedup(spark, sf):
    return mart.currency_daily(demo.staged(spark, sf, "currency"), dedupe=True)


@register("currency_latest", with_("newest_rate") + "SELECT * FROM newest_rate")
def q_currency_latest(spark, sf):
    return mart.currency_latest(demo.staged(spark, sf, "currency"))


@register("news_daily_mentions", with_("news_daily") + "SELECT * FROM news_daily")
def q_news_daily(spark, sf):
    return mart.news_daily(demo.staged(spark, sf, "news"))


@register("macro_latest", with_("macro_newest") + "SELECT * FROM macro_newest")
def q_macro_latest(spark, sf):
    return mart.macro_latest(demo.staged(spark, sf, "fred"))


@register("macro_latest_window", with_("macro_newest") + "SELECT * FROM macro_newest")
def q_macro_latest_window(spark, sf):
    return mart.macro_latest(demo.staged(spark, sf, "fred"), method="window")


@register("macro_pivot", with_("macro_wide") + "SELECT * FROM macro_wide")
def q_macro_pivot(spark, sf):
    return mart.macro_pivot(demo.staged(spark, sf, "fred"))


# --- flatten (FLT-1..6) and validate (VAL-1..14) -----------------------------
from lodestone.functions.casts import safe_bigint, safe_double  # noqa: E402
from lodestone.operators import envelope, flatten, validate  # noqa: E402
from lodestone.plans import documents  # noqa: E402
from lodestone.plans.oracle import CTE  # noqa: E402

DOMAINS = {"metal": demo.DEMO_SYMBOLS, "currency": None, "fred": None, "news": demo.DEMO_SYMBOLS}


def flat(spark, sf, feed):
    docs = envelope.accepted_documents(documents.DOCS[feed](spark, sf), feed)
    dom = DOMAINS[feed]
    return flatten.FLATTENERS[feed](docs, dom) if dom else flatten.FLATTENERS[feed](docs)


TYPED_OUT = {
    "metal": lambda df: df.withColumn("price_usd", safe_double("price_usd")),
    "currency": lambda df: df.withColumn("exchange_rate", safe_double("exchange_rate")),
    "fred": lambda df: df.withColumn("observation_values", F.when(F.col("observation_values") != ".",
                                                                  safe_double("observation_values"))),
    "news": lambda df: df.withColumn("total_mentions", safe_bigint("total_mentions")),
}


def checked(spark, sf, feed):
    return validate.check(flat(spark, sf, feed), feed)


def with_reasons_text(df):
    return df.withColumn("reject_reasons", F.array_join("reject_reasons", ","))


for _feed in ("metal", "currency", "fred", "news"):
    register(f"flatten_{_feed}", with_(extra={"x": CTE[f"flat_{_feed}"]}) + f"SELECT * FROM flat_{_feed}")(
        (lambda feed: lambda spark, sf: TYPED_OUT[feed](flat(spark, sf, feed)))(_feed))
    register(f"validate_{_feed}", with_(extra={"x": CTE[f"flat_{_feed}"]}) + CTE[f"validated_{_feed}"])(
        (lambda feed: lambda spark, sf: with_reasons_text(checked(spark, sf, feed)))(_feed))


@register("reject_summary", with_(extra={f: CTE[f"flat_{f}"] for f in ("metal", "currency", "fred", "news")})
          + CTE["reject_summary"])
def q_reject_summary(spark, sf):
    parts = [validate.reject_summary(checked(spark, sf, f), f) for f in ("metal", "currency", "fred", "news")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# Every rule of every feed, on rows straight from the tables with one fault in
# so many rows (documents.RAW); reasons counted per rule.
@register("reject_rules", CTE["reject_rules"])
def q_reject_rules(spark, sf):
    parts = [validate.reject_summary(validate.check(raw(spark, sf), f), f) for f, raw in documents.RAW.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("flexible_dates", CTE["flexible_dates"])
def q_flexible_dates(spark, sf):
    """Order dates in rotating spellings, parsed back (VAL-5, VAL-6)."""
    from lodestone.functions.casts import flexible_timestamp
    return documents.spelled_dates(spark, sf).select("o_orderkey", flexible_timestamp("spelled").alias("parsed"))


@register("rejected_documents", CTE["rejected_documents"])
def q_rejected_documents(spark, sf):
    """Refused macro documents per load day and reason, empty, broken, empty
    object and without the wanted series (ENV-1, ENV-4)."""
    chk = envelope.check_envelope(documents.faulty_fred_docs(spark, sf), "fred", ("DGS10",), complete=True)
    return (chk.where(F.col("envelope_error").isNotNull()).groupBy("ingested_at", "envelope_error")
            .agg(F.count("*").alias("n_docs")))


@register("envelope_summary", CTE["envelope_summary"])
def q_envelope_summary(spark, sf):
    parts = []
    for feed in ("metal", "currency", "fred", "news"):
        docs = documents.DOCS[feed](spark, sf)
        dom = demo.DEMO_SYMBOLS if feed == "news" else None
        chk = envelope.check_envelope(docs, feed, dom, complete=(feed == "news"))
        parts.append(chk.groupBy(F.coalesce("envelope_error", F.lit("ok")).alias("envelope_error"))
                     .agg(F.count("*").alias("n_docs")).select(F.lit(feed).alias("feed"), "envelope_error", "n_docs"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- request windows (ENV-5, ENV-6) and partition window (SRC-8) -------------
RUN_DATE = "2000-06-30"


@register("lookback_window", with_("stg_fred_data") + CTE["lookback_window"].format(run=RUN_DATE))
def q_lookback(spark, sf):
    return envelope.lookback_window(demo.staged(spark, sf, "fred"), "series_id", "observation_date", RUN_DATE)


@register("news_window", with_("stg_news_data") + CTE["news_window"].format(run=RUN_DATE))
def q_news_window(spark, sf):
    return envelope.news_window(demo.staged(spark, sf, "news"), "event_timestamp", RUN_DATE)


@register("partition_window", with_(extra={"s": CTE["silver_metal"]})
          + f"SELECT * FROM silver_metal WHERE ingested_at BETWEEN '1999-01-01' AND '{RUN_DATE}'")
def q_partition_window(spark, sf):
    """The window on a written, day-partitioned table: folders are pruned."""
    from lodestone.session import shared_path
    from lodestone.sources import silver
    path = shared_path(spark, "silver-metal")
    silver.write_silver(demo.silver_metal(spark, sf), path, "metal")
    return silver.partition_window(silver.read_silver(spark, path, "metal"), RUN_DATE, start="1999-01-01").drop("loaded_at")


@register("silver_catalog_table", with_(extra={"s": CTE["silver_currency"]})
          + """SELECT ingested_at, currency_code, CAST(count(*) AS BIGINT) AS n_rows, max(exchange_rate) AS highest
FROM silver_currency GROUP BY ALL""")
def q_catalog(spark, sf):
    """FX rows written as a silver table, registered and read through the catalog."""
    from lodestone.session import shared_path
    from lodestone.sources import silver
    path = shared_path(spark, "silver-currency")
    silver.write_silver(demo.silver_currency(spark, sf), path, "currency")
    name = "t" + path.rsplit("-", 1)[-1]
    silver.register_table(spark, "lodestone_demo", name, path, "currency", start="1990-01-01", end="2005-12-31")
    return spark.table(f"lodestone_demo.{name}").groupBy("ingested_at", "currency_code").agg(
        F.count("*").alias("n_rows"), F.max("exchange_rate").alias("highest"))


# --- dashboard (DASH-1..6) ------------------------------------------------------
from lodestone.plans import dashboard  # noqa: E402

_MARTS: dict[tuple[str, str], str] = {}


def stored_mart(spark, sf):
    """The mart table the charts read: built once per session and input."""
    from lodestone.plans import daily
    from lodestone.session import shared_path
    key = (spark.sparkContext.applicationId, sf)
    if key not in _MARTS:
        path = shared_path(spark, "dash-mart")
        fact(spark, sf).write.parquet(path)
        _MARTS[key] = path
    return daily.read_fact(spark, _MARTS[key])


register("dash_price_daily", with_("fact") + CTE["dash_price_daily"])(
    lambda spark, sf: dashboard.price_daily(stored_mart(spark, sf)))
for _col, _name in (("usd_index", "dash_price_vs_usd"), ("yield_10y", "dash_price_vs_yield"),
                    ("cpi_index", "dash_price_vs_cpi")):
    register(_name, with_("fact") + CTE["dash_price_vs"].format(col=_col))(
        (lambda col: lambda spark, sf: dashboard.price_vs(stored_mart(spark, sf), col))(_col))
register("dash_news_pairs", with_("fact") + CTE["dash_news_pairs"])(
    lambda spark, sf: dashboard.news_price_pairs(stored_mart(spark, sf)))
register("dash_news_corr", with_("fact") + CTE["dash_news_corr"])(
    lambda spark, sf: dashboard.news_price_corr(stored_mart(spark, sf)).withColumn(
        "corr_mentions_price", F.round("corr_mentions_price", 6)))
register("dash_usd_idr", with_("fact") + CTE["dash_usd_idr"])(
    lambda spark, sf: dashboard.usd_idr(stored_mart(spark, sf)).withColumn("avg_usd_to_idr", F.round("avg_usd_to_idr", 4)))


# --- keyword mentions over documents (ENV-7) ------------------------------------
from lodestone import config  # noqa: E402
from lodestone.operators import mentions  # noqa: E402

# Common words of the four languages of the document table, used
# to exercise the operator where the metal keywords never occur.
DEMO_WORDS = ("the", "and", "of", "le", "la", "de", "el", "der", "und")

register("keyword_mentions", CTE["keyword_mentions"].format(kws=config.NEWS_KEYWORDS, kwlist=list(config.NEWS_KEYWORDS)))(
    lambda spark, sf: mentions.keyword_mentions(spark, demo.table(spark, sf, "documents", per_row_heavy=True), config.NEWS_KEYWORDS))
register("keyword_mentions_words", CTE["keyword_mentions"].format(kws=DEMO_WORDS, kwlist=list(DEMO_WORDS)))(
    lambda spark, sf: mentions.keyword_mentions(spark, demo.table(spark, sf, "documents", per_row_heavy=True), DEMO_WORDS))
register("keyword_mentions_by_lang", CTE["keyword_mentions_by"].format(kws=DEMO_WORDS, by="lang"))(
    lambda spark, sf: mentions.keyword_mentions(spark, demo.table(spark, sf, "documents", per_row_heavy=True), DEMO_WORDS,
                                                by=["lang"]))
register("keyword_mentions_by_source", CTE["keyword_mentions_by"].format(kws=config.NEWS_KEYWORDS + DEMO_WORDS,
                                                                          by="source"))(
    lambda spark, sf: mentions.keyword_mentions(spark, demo.table(spark, sf, "documents", per_row_heavy=True),
                                                config.NEWS_KEYWORDS + DEMO_WORDS, by=["source"]))


# --- nested key clean-up (JSN-1) -------------------------------------------------
from lodestone.functions.generators import explode_exact  # noqa: E402
from lodestone.functions.keys import sanitize_column, sanitize_keys  # noqa: E402


@register("sanitize_keys_map", CTE["sanitize_keys_map"])
def q_sanitize_map(spark, sf):
    li = demo.table(spark, sf, "lineitem", per_row_heavy=True)
    raw = F.map_from_arrays(
        F.array(F.concat_ws("-", "l_returnflag", "l_linestatus"), F.concat_ws("_", "l_returnflag", "l_linestatus"),
                F.concat(F.col("l_linenumber").cast("string"), F.lit(" line"))),
        F.array("l_quantity", "l_tax", "l_discount"))
    df = li.select("l_orderkey", "l_linenumber", raw.alias("m"))
    clean = sanitize_keys(df, "m")
    return explode_exact(clean, ["l_orderkey", "l_linenumber"], F.col("m"), ["key", "value"], position="pos")


STRUCT_DOC = ("`order-key` bigint, `1st priority` string, `total price` double, "
              "status struct<`code.value`: string, code_value: bigint>")


@register("sanitize_keys_struct", CTE["sanitize_keys_struct"])
def q_sanitize_struct(spark, sf):
    o = demo.table(spark, sf, "orders", per_row_heavy=True)
    doc = F.to_json(F.struct(F.col("o_orderkey").alias("order-key"), F.col("o_orderpriority").alias("1st priority"),
                             F.col("o_totalprice").alias("total price"),
                             F.struct(F.col("o_orderstatus").alias("code.value"),
                                      F.col("o_custkey").alias("code_value")).alias("status")))
    parsed = o.select(F.from_json(doc, STRUCT_DOC).alias("d"))
    clean = parsed.select(sanitize_column(F.col("d"), parsed.schema["d"].dataType).alias("d"))
    return clean.select("d.order_key", "d._1st_priority", "d.total_price",
                        F.col("d.status.code_value").alias("status_code_value"),
                        F.size(F.array(F.col("d.status.*"))).alias("status_fields"))


# --- NDJSON lines (SRC-13, JSN-3) -------------------------------------------------
from lodestone.sources.bronze import to_ndjson  # noqa: E402


@register("ndjson_rows", with_(extra={"s": CTE["silver_fred"]}) + CTE["ndjson_rows"])
def q_ndjson(spark, sf):
    s = demo.silver_fred(spark, sf, per_row_heavy=True)
    lines = s.select(to_ndjson(s).alias("line"))
    m = lines.select(F.from_json("line", "map<string,string>").alias("m"))
    return m.select(F.col("m.series_id"), F.col("m.observation_date"), F.col("m.observation_values").cast("double").alias("observation_values"),
                    F.size("m").alias("n_keys"))


# --- back-fill manifest (MIG-1..10) ----------------------------------------------
from lodestone.operators import backfill  # noqa: E402


def _manifest(spark, sf):
    return backfill.manifest(documents.backfill_listing(spark, sf)).drop("content")


register("backfill_manifest", with_(extra={"m": CTE["backfill_manifest"]}) + "SELECT * FROM manifest")(_manifest)
# The summary and the candidates need outcomes and new keys only, not winners.
register("backfill_summary", with_(extra={"m": CTE["backfill_manifest"]}) + CTE["backfill_summary"])(
    lambda spark, sf: backfill.summary(backfill.classify(documents.backfill_listing(spark, sf))))
register("backfill_delete_candidates", with_(extra={"m": CTE["backfill_manifest"]})
         + "SELECT layer, old_key, new_key FROM manifest WHERE outcome = 'migrated'")(
    lambda spark, sf: backfill.delete_candidates(backfill.classify(documents.backfill_listing(spark, sf))))


# --- silver and mart tables written and read back (SRC-3..7, SRC-12) -------------
from lodestone.plans import daily  # noqa: E402
from lodestone.session import shared_path  # noqa: E402
from lodestone.sources import silver as silver_io  # noqa: E402


@register("silver_roundtrip", with_(extra={"x": CTE["flat_fred"]}) + CTE["silver_roundtrip"])
def q_silver_roundtrip(spark, sf):
    """Macro documents -> validated rows -> day-partitioned silver table in the
    shared folder -> read back with the fixed schema -> staging."""
    path = shared_path(spark, "silver-fred")
    valid, _ = validate.validate(flat(spark, sf, "fred"), "fred")
    silver_io.write_silver(valid, path, "fred")
    from lodestone.operators.staging import stg_fred_data
    return stg_fred_data(silver_io.read_silver(spark, path, "fred"))


@register("silver_roundtrip_news", CTE["silver_roundtrip_news"])
def q_silver_roundtrip_news(spark, sf):
    """News rows, one per line item and some faulty, validated, written as a
    day-partitioned silver table (SRC-7) and read back into staging; rows the
    rules reject must not be in it."""
    path = shared_path(spark, "silver-news")
    valid, _ = validate.split(validate.check(documents.RAW["news"](spark, sf), "news"))
    silver_io.write_silver(valid, path, "news")
    from lodestone.operators.staging import stg_news_data
    return stg_news_data(silver_io.read_silver(spark, path, "news"))


@register("bronze_roundtrip", with_(extra={"x": CTE["flat_fred"]}) + "SELECT * FROM flat_fred")
def q_bronze_roundtrip(spark, sf):
    """Macro documents, one per line item, written as bronze day files (SRC-2),
    read back as NDJSON (SRC-1) and flattened."""
    from lodestone.sources import bronze
    path = shared_path(spark, "bronze-fred")
    bronze.write_bronze(documents.DOCS["fred"](spark, sf), path)
    docs = envelope.accepted_documents(bronze.read_bronze(spark, path), "fred")
    return TYPED_OUT["fred"](flatten.flatten_fred(docs))


@register("mart_roundtrip", with_("fact") + "SELECT * FROM fact")
def q_mart_roundtrip(spark, sf):
    """The fact written as the trade-date partitioned mart table and read back."""
    path = shared_path(spark, "mart")
    daily.write_mart(fact(spark, sf), path)
    return daily.read_mart(spark, path)


# --- landing: gather per-keyword responses into one document (SRC-16/17, ENV-4) ----
from lodestone.sources.bronze import gather_responses  # noqa: E402


@register("gather_news_documents", CTE["gather_news_documents"])
def q_gather_news(spark, sf):
    li = demo.table(spark, sf, "lineitem")
    per = li.groupBy(F.to_date("l_shipdate").alias("d"), demo.symbol().alias("key")).agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("total"))
    resp = per.select(demo.day_text("d").alias("ingested_at"), "key",
                      F.to_json(F.struct(F.lit("ok").alias("status"), F.col("total").alias("totalResults"))).alias("body"))
    docs = gather_responses(resp, demo.DEMO_SYMBOLS)
    m = F.from_json("value", "map<string,struct<status:string,totalResults:bigint>>")
    return docs.select("ingested_at", m.alias("m")).select(
        "ingested_at", F.size("m").cast("bigint").alias("n_keys"),
        F.aggregate(F.map_values("m"), F.lit(0).cast("bigint"), lambda acc, x: acc + x["totalResults"]).alias("total_mentions"))


@register("gather_macro_documents", CTE["gather_macro_documents"])
def q_gather_macro(spark, sf):
    """One response per line item: of the many fetches of a day and series the newest counts."""
    li = demo.table(spark, sf, "lineitem")
    resp = li.select(demo.day_text("l_shipdate").alias("ingested_at"), demo._case("l_returnflag", demo.FLAG_SERIES).alias("key"),
                     F.to_json(F.struct(F.col("l_extendedprice").alias("v"))).alias("body"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("at"))
    m = F.from_json("value", "map<string,struct<v:double>>")
    return gather_responses(resp, config.FRED_SERIES, fetched_col="at").select("ingested_at", m.alias("m")).select(
        "ingested_at", *[F.col("m")[s]["v"].alias(s.lower()) for s in config.FRED_SERIES])


# --- data quality: price unit (T-15) ------------------------------------------------
@register("metal_units", with_("stg_metal_prices") + CTE["metal_units"])
def q_metal_units(spark, sf):
    return demo.staged(spark, sf, "metal").groupBy("unit").agg(F.count("*").alias("n_rows"))


# --- completeness per load day (ENV-4) ----------------------------------------------
@register("completeness_check", with_("stg_fred_data") + CTE["completeness_check"])
def q_completeness(spark, sf):
    """Load days of the macro feed that lack a configured series, and which.
    The per-day set is bounded by the configured list (pre-filtered)."""
    fred = demo.staged(spark, sf, "fred").where(F.col("series_id").isin(list(config.FRED_SERIES)))
    per_day = fred.groupBy("event_timestamp").agg(F.collect_set("series_id").alias("present"))
    missing = F.array_except(envelope.domain_array(config.FRED_SERIES), F.col("present"))
    return (per_day.select(F.col("event_timestamp").alias("load_day"), F.size("present").cast("bigint").alias("n_present"),
                           F.array_join(F.array_sort(missing), ",").alias("missing"))
            .where(F.col("missing") != ""))
