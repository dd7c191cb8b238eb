"""DuckDB SQL for the oracle check: the same demo mapping and pipeline,
written as plain SQL over the driver's tables (views ``lineitem``,
``orders``, ``events``, ``documents``, ...).

Each ``with_(...)`` call assembles the CTEs a query needs, in dependency order.
"""

from __future__ import annotations

from lodestone import config
from lodestone.plans.demo import FLAG_SERIES, PRIORITY_CURRENCY
from lodestone.plans.documents import SPELLINGS


def _case(col: str, pairs) -> str:
    return "CASE " + " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in pairs) + " END"


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


CTE: dict[str, str] = {}

CTE["silver_metal"] = f"""silver_metal AS (
  SELECT strftime(max(ts), '%Y-%m-%dT%H:%M:%S') AS event_timestamp, metal_symbol,
         max(price) AS price_usd, 'USD' AS currency_base, 'g' AS unit,
         strftime(d, '%Y-%m-%d') AS ingested_at
  FROM (SELECT CAST(l_shipdate AS DATE) AS d, l_returnflag || l_linestatus AS metal_symbol,
               l_extendedprice AS price, l_shipdate AS ts FROM lineitem)
  GROUP BY d, metal_symbol)"""

CTE["silver_currency"] = f"""silver_currency AS (
  SELECT strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS rate_date,
         {_case('o_orderpriority', PRIORITY_CURRENCY)} AS currency_code,
         o_totalprice AS exchange_rate, 'USD' AS base_currency,
         strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS ingested_at
  FROM orders)"""

CTE["silver_fred"] = f"""silver_fred AS (
  SELECT {_case('l_returnflag', FLAG_SERIES)} AS series_id,
         strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS observation_date,
         CASE WHEN l_discount <> 0 THEN l_extendedprice END AS observation_values,
         'lin' AS units,
         strftime(CAST(l_shipdate AS DATE) + l_linenumber, '%Y-%m-%d') AS ingested_at
  FROM lineitem)"""

CTE["silver_news"] = f"""silver_news AS (
  SELECT strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.%f') AS news_timestamp,
         l_returnflag || l_linestatus AS keywords,
         CAST(trunc(l_quantity) AS BIGINT) AS total_mentions, 'ok' AS status,
         strftime(CAST(l_shipdate AS DATE), '%Y-%m-%d') AS ingested_at
  FROM lineitem)"""

CTE["stg_metal_prices"] = """stg_metal_prices AS (
  SELECT CAST(SUBSTRING(ingested_at, 1, 10) AS DATE) AS trade_date, metal_symbol AS commodity_code,
         CAST(price_usd AS DOUBLE) AS price_usd, unit,
         CAST(SUBSTRING(CAST(event_timestamp AS VARCHAR), 1, 19) AS TIMESTAMP) AS event_timestamp
  FROM silver_metal)"""

CTE["stg_currency_rates"] = """stg_currency_rates AS (
  SELECT CAST(SUBSTRING(rate_date, 1, 10) AS DATE) AS rate_date, currency_code,
         CAST(exchange_rate AS DOUBLE) AS exchange_rate, base_currency,
         CAST(SUBSTRING(ingested_at, 1, 10) AS DATE) AS event_timestamp
  FROM silver_currency)"""

CTE["stg_fred_data"] = """stg_fred_data AS (
  SELECT series_id, CAST(SUBSTRING(observation_date, 1, 10) AS DATE) AS observation_date,
         CAST(observation_values AS DOUBLE) AS observation_values, units,
         CAST(SUBSTRING(ingested_at, 1, 10) AS DATE) AS event_timestamp
  FROM silver_fred)"""

CTE["stg_news_data"] = """stg_news_data AS (
  SELECT CAST(SUBSTRING(CAST(news_timestamp AS VARCHAR), 1, 19) AS TIMESTAMP) AS news_timestamp,
         keywords AS topics, total_mentions, status,
         CAST(SUBSTRING(ingested_at, 1, 10) AS DATE) AS event_timestamp
  FROM silver_news)"""

T = config.TARGET_CURRENCY

CTE["currency_daily"] = f"""currency_daily AS (
  SELECT rate_date, exchange_rate FROM stg_currency_rates WHERE currency_code = '{T}')"""

CTE["currency_daily_dedup"] = f"""currency_daily_dedup AS (
  SELECT rate_date, exchange_rate FROM (
    SELECT rate_date, exchange_rate,
           row_number() OVER (PARTITION BY rate_date ORDER BY event_timestamp DESC NULLS LAST,
                              exchange_rate DESC NULLS LAST) AS rn
    FROM stg_currency_rates WHERE currency_code = '{T}') WHERE rn = 1)"""

CTE["newest_rate"] = f"""newest_rate AS (
  SELECT first(exchange_rate ORDER BY rate_date DESC, event_timestamp DESC, exchange_rate DESC) AS latest_rate
  FROM stg_currency_rates WHERE currency_code = '{T}')"""

CTE["news_daily"] = """news_daily AS (
  SELECT event_timestamp AS news_date, topics, CAST(sum(total_mentions) AS BIGINT) AS daily_mentions
  FROM stg_news_data GROUP BY 1, 2)"""

CTE["macro_newest"] = f"""macro_newest AS (
  SELECT series_id, first(observation_values ORDER BY observation_date DESC, event_timestamp DESC, observation_values DESC NULLS LAST) AS observation_values
  FROM stg_fred_data WHERE series_id IN {_in(config.FRED_SERIES)} GROUP BY series_id)"""

CTE["macro_wide"] = "macro_wide AS (SELECT " + ", ".join(
    f"any_value(observation_values) FILTER (WHERE series_id = '{s}') AS {c}" for s, c in config.MACRO_COLUMNS) + " FROM macro_newest)"


def _fact_sql(name: str, daily: str) -> str:
    macro = ", ".join(f"(SELECT {c} FROM macro_wide) AS {c}" for _, c in config.MACRO_COLUMNS)
    return f"""{name} AS (
  SELECT code AS commodity_code, usd AS price_usd_per_gr, idr AS usd_to_idr, usd * idr AS price_idr_per_gr,
         CAST(coalesce(hits.daily_mentions, 0) AS BIGINT) AS news_hype_count, {macro}, day AS trade_date
  FROM (SELECT metal.trade_date AS day, metal.commodity_code AS code, metal.price_usd AS usd,
               coalesce(fx.exchange_rate, (SELECT latest_rate FROM newest_rate)) AS idr
        FROM {daily} AS fx RIGHT JOIN stg_metal_prices AS metal ON fx.rate_date = metal.trade_date) AS priced
  LEFT JOIN news_daily AS hits ON hits.topics = code AND hits.news_date = day
  WHERE (SELECT latest_rate FROM newest_rate) IS NOT NULL)"""


CTE["fact"] = _fact_sql("fact", "currency_daily")
CTE["fact_dedup"] = _fact_sql("fact_dedup", "currency_daily_dedup")

DEPS = {
    "stg_metal_prices": ["silver_metal"],
    "stg_currency_rates": ["silver_currency"],
    "stg_fred_data": ["silver_fred"],
    "stg_news_data": ["silver_news"],
    "currency_daily": ["stg_currency_rates"],
    "currency_daily_dedup": ["stg_currency_rates"],
    "newest_rate": ["stg_currency_rates"],
    "news_daily": ["stg_news_data"],
    "macro_newest": ["stg_fred_data"],
    "macro_wide": ["macro_newest"],
    "fact": ["stg_metal_prices", "currency_daily", "news_daily", "newest_rate", "macro_wide"],
    "fact_dedup": ["stg_metal_prices", "currency_daily_dedup", "news_daily", "newest_rate", "macro_wide"],
}


def _closure(names) -> list[str]:
    seen: list[str] = []

    def visit(n):
        for d in DEPS.get(n, []):
            visit(d)
        if n not in seen:
            seen.append(n)

    for n in names:
        visit(n)
    return seen


def with_(*names: str, extra: dict[str, str] | None = None) -> str:
    """``WITH`` clause holding ``names`` and everything they depend on."""
    parts = [CTE[n] for n in _closure(names)]
    parts += list((extra or {}).values())
    return "WITH " + ",\n".join(parts) + "\n"


# --- documents: expected flattened rows ----------------------------------------
from lodestone.plans.demo import DEMO_SYMBOLS  # noqa: E402

_SYMS = "(VALUES " + ", ".join(f"('{s}')" for s in DEMO_SYMBOLS) + ") AS syms(sym)"
_CCYS = "(VALUES " + ", ".join(f"('{s}')" for s in config.CURRENCIES) + ") AS ccys(code)"
_ISO_US = "'%Y-%m-%dT%H:%M:%S.%f'"

CTE["flat_metal"] = f"""flat_metal AS (
  SELECT strftime(md.ts, '%Y-%m-%dT%H:%M:%SZ') AS event_timestamp, syms.sym AS metal_symbol,
         CASE WHEN p.price IS NULL THEN NULL WHEN day(md.d) = 13 THEN -p.price
              WHEN day(md.d) = 29 THEN NULL ELSE p.price END AS price_usd,
         'USD' AS currency_base, 'g' AS unit, strftime(md.d, '%Y-%m-%d') AS ingested_at
  FROM (SELECT CAST(l_shipdate AS DATE) AS d, max(l_shipdate) AS ts FROM lineitem GROUP BY 1) md
  CROSS JOIN {_SYMS}
  LEFT JOIN (SELECT CAST(l_shipdate AS DATE) AS d, l_returnflag || l_linestatus AS sym,
                    max(l_extendedprice) AS price FROM lineitem GROUP BY 1, 2) p
         ON p.d = md.d AND p.sym = syms.sym
  WHERE day(md.d) <> 31)"""

CTE["validated_metal"] = f"""SELECT strftime(CAST(substr(event_timestamp, 1, 19) AS TIMESTAMP), {_ISO_US}) AS event_timestamp,
       metal_symbol, price_usd, currency_base, unit, ingested_at,
       concat_ws(',', CASE WHEN price_usd IS NULL OR price_usd <= 0 THEN 'VAL-3' END) AS reject_reasons
FROM flat_metal"""

CTE["flat_currency"] = f"""flat_currency AS (
  SELECT CASE WHEN day(cd.d) = 7 THEN 'someday'
              ELSE strftime(cd.d, '%Y-%m-%d %H:%M:%S') || '+00' END AS rate_date,
         ccys.code AS currency_code,
         CASE WHEN p.rate IS NULL THEN NULL WHEN day(cd.d) = 13 THEN 0.0
              WHEN day(cd.d) = 29 THEN NULL ELSE p.rate END AS exchange_rate,
         'USD' AS base_currency, strftime(cd.d, '%Y-%m-%d') AS ingested_at
  FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders) cd
  CROSS JOIN {_CCYS}
  LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS d, {_case('o_orderpriority', PRIORITY_CURRENCY)} AS code,
                    max(o_totalprice) AS rate FROM orders GROUP BY 1, 2) p
         ON p.d = cd.d AND p.code = ccys.code)"""

CTE["validated_currency"] = f"""SELECT CASE WHEN rate_date = 'someday' THEN NULL
            ELSE strftime(CAST(substr(rate_date, 1, 19) AS TIMESTAMP), {_ISO_US}) END AS rate_date,
       currency_code, exchange_rate, base_currency, ingested_at,
       concat_ws(',', CASE WHEN rate_date = 'someday' THEN 'VAL-5' END,
                      CASE WHEN exchange_rate IS NULL OR exchange_rate <= 0 THEN 'VAL-7' END) AS reject_reasons
FROM flat_currency"""

CTE["flat_fred"] = f"""flat_fred AS (
  SELECT {_case('l_returnflag', FLAG_SERIES)} AS series_id,
         strftime(l_shipdate, '%Y-%m-%d') AS observation_date,
         CASE WHEN l_discount = 0 THEN NULL WHEN l_tax = 0 THEN -l_extendedprice
              ELSE l_extendedprice END AS observation_values,
         'lin' AS units,
         strftime(CAST(l_shipdate AS DATE) + l_linenumber, '%Y-%m-%d') AS ingested_at
  FROM lineitem)"""

CTE["validated_fred"] = f"""SELECT series_id, strftime(CAST(observation_date AS TIMESTAMP), {_ISO_US}) AS observation_date,
       observation_values, units, ingested_at,
       concat_ws(',', CASE WHEN observation_values <= 0 THEN 'VAL-11' END) AS reject_reasons
FROM flat_fred"""

CTE["flat_news"] = f"""flat_news AS (
  SELECT strftime(nd.d, '%Y-%m-%d') || 'T00:00:00' AS news_timestamp, syms.sym AS keywords,
         CAST(CASE WHEN p.sym IS NULL THEN 0 WHEN day(nd.d) = 29 THEN 0 WHEN day(nd.d) = 30 THEN NULL
                   ELSE p.total END AS BIGINT) AS total_mentions,
         CASE WHEN p.sym IS NULL THEN 'unknown' WHEN day(nd.d) = 13 THEN 'error' ELSE 'ok' END AS status,
         strftime(nd.d, '%Y-%m-%d') AS ingested_at
  FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem) nd
  CROSS JOIN {_SYMS}
  LEFT JOIN (SELECT CAST(l_shipdate AS DATE) AS d, l_returnflag || l_linestatus AS sym,
                    CAST(sum(CAST(trunc(l_quantity) AS BIGINT)) AS BIGINT) AS total
             FROM lineitem GROUP BY 1, 2) p
         ON p.d = nd.d AND p.sym = syms.sym)"""

CTE["validated_news"] = f"""SELECT strftime(CAST(news_timestamp AS TIMESTAMP), {_ISO_US}) AS news_timestamp,
       keywords, total_mentions, status, ingested_at,
       concat_ws(',', CASE WHEN total_mentions IS NULL OR total_mentions < 0 THEN 'VAL-12' END,
                      CASE WHEN status <> 'ok' THEN 'VAL-13' END) AS reject_reasons
FROM flat_news"""

CTE["reject_summary"] = """SELECT feed, rule_id, CAST(count(*) AS BIGINT) AS n_rows FROM (
  SELECT 'metal' AS feed, 'VAL-3' AS rule_id FROM flat_metal WHERE price_usd IS NULL OR price_usd <= 0
  UNION ALL SELECT 'currency', 'VAL-5' FROM flat_currency WHERE rate_date = 'someday'
  UNION ALL SELECT 'currency', 'VAL-7' FROM flat_currency WHERE exchange_rate IS NULL OR exchange_rate <= 0
  UNION ALL SELECT 'fred', 'VAL-11' FROM flat_fred WHERE observation_values <= 0
  UNION ALL SELECT 'news', 'VAL-12' FROM flat_news WHERE total_mentions IS NULL OR total_mentions < 0
  UNION ALL SELECT 'news', 'VAL-13' FROM flat_news WHERE status <> 'ok'
) GROUP BY feed, rule_id"""

_RULES = (("metal", "VAL-1", 11), ("metal", "VAL-2", 13), ("metal", "VAL-3", 17), ("metal", "VAL-4", 19),
          ("currency", "VAL-5", 11), ("currency", "VAL-7", 17), ("currency", "VAL-8", 13), ("currency", "VAL-8", 19),
          ("fred", "VAL-9", 11), ("fred", "VAL-9", 13), ("fred", "VAL-11", 17),
          ("news", "VAL-12", 17), ("news", "VAL-13", 19), ("news", "VAL-14", 13))
CTE["reject_rules"] = ("WITH n AS (SELECT l_orderkey * 8 + l_linenumber AS n FROM lineitem) " + " UNION ALL ".join(
    f"SELECT '{feed}' AS feed, '{rule}' AS rule_id, CAST(count(*) AS BIGINT) AS n_rows FROM n WHERE "
    + " OR ".join(f"n % {k} = 0" for f, r, k in _RULES if (f, r) == (feed, rule)) for feed, rule in dict.fromkeys((f, r) for f, r, _ in _RULES)))

CTE["flexible_dates"] = "SELECT o_orderkey, CASE " + " ".join(
    f"WHEN o_orderkey % {len(SPELLINGS)} = {i} THEN date_trunc('{left}', o_orderdate)" for i, (_, left) in enumerate(SPELLINGS)) + " END AS parsed FROM orders"

CTE["rejected_documents"] = """SELECT strftime(l_shipdate, '%Y-%m-%d') AS ingested_at, e AS envelope_error, CAST(count(*) AS BIGINT) AS n_docs FROM (
  SELECT l_shipdate, CASE WHEN n % 11 = 0 THEN 'empty' WHEN n % 13 = 0 THEN 'not_json' WHEN n % 17 = 0 THEN 'empty_object'
    WHEN l_returnflag <> 'A' THEN 'incomplete' END AS e FROM (SELECT *, l_orderkey * 8 + l_linenumber AS n FROM lineitem))
WHERE e IS NOT NULL GROUP BY ALL"""

CTE["gather_macro_documents"] = ("SELECT ingested_at, " + ", ".join(f"max(v) FILTER (WHERE s = '{x}') AS {x.lower()}" for x in config.FRED_SERIES)
    + f""" FROM (SELECT strftime(l_shipdate, '%Y-%m-%d') AS ingested_at, {_case('l_returnflag', FLAG_SERIES)} AS s,
  arg_max(l_extendedprice, l_orderkey * 8 + l_linenumber) AS v FROM lineitem GROUP BY ALL) GROUP BY ingested_at HAVING count(*) = 3""")

CTE["envelope_summary"] = f"""SELECT feed, envelope_error, CAST(count(*) AS BIGINT) AS n_docs FROM (
  SELECT 'metal' AS feed, CASE WHEN day(d) = 31 THEN 'status' ELSE 'ok' END AS envelope_error
  FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem)
  UNION ALL SELECT 'currency', 'ok' FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) FROM orders)
  UNION ALL SELECT 'fred', 'ok' FROM lineitem
  UNION ALL SELECT 'news', CASE WHEN count(DISTINCT l_returnflag || l_linestatus) < {len(DEMO_SYMBOLS)}
                                THEN 'incomplete' ELSE 'ok' END
  FROM lineitem GROUP BY CAST(l_shipdate AS DATE)
) GROUP BY feed, envelope_error"""

_LOOKBACK = "CASE " + " ".join(f"WHEN series_id = '{s}' THEN {d}" for s, d in config.LOOKBACK_DAYS.items()) \
    + f" ELSE {config.DEFAULT_LOOKBACK_DAYS} END"

CTE["lookback_window"] = ("SELECT * FROM stg_fred_data WHERE observation_date BETWEEN "
                          "CAST('{run}' AS DATE) - CAST(" + _LOOKBACK.replace("{", "{{").replace("}", "}}")
                          + " AS INTEGER) AND CAST('{run}' AS DATE)")
CTE["news_window"] = (f"SELECT * FROM stg_news_data WHERE event_timestamp BETWEEN "
                      f"CAST('{{run}}' AS DATE) - {config.NEWS_WINDOW_DAYS} AND CAST('{{run}}' AS DATE)")


# --- dashboard ------------------------------------------------------------------
CTE["dash_price_daily"] = """SELECT trade_date, commodity_code, max(price_usd_per_gr) AS price_usd_per_gr
FROM fact GROUP BY trade_date, commodity_code"""
CTE["dash_price_vs"] = """SELECT trade_date, commodity_code, max(price_usd_per_gr) AS price_usd_per_gr, max({col}) AS {col}
FROM fact GROUP BY trade_date, commodity_code"""
CTE["dash_news_pairs"] = """SELECT trade_date, commodity_code, max(news_hype_count) AS mentions,
       max(price_usd_per_gr) AS price
FROM fact GROUP BY trade_date, commodity_code"""
CTE["dash_news_corr"] = """SELECT commodity_code, round(corr(CAST(mentions AS DOUBLE), price), 6) AS corr_mentions_price,
       CAST(count(*) AS BIGINT) AS n_days
FROM (SELECT trade_date, commodity_code, max(news_hype_count) AS mentions, max(price_usd_per_gr) AS price
      FROM fact GROUP BY trade_date, commodity_code) GROUP BY commodity_code"""
CTE["dash_usd_idr"] = """SELECT trade_date, round(avg(usd_to_idr), 4) AS avg_usd_to_idr,
       (SELECT usd_to_idr FROM fact ORDER BY trade_date DESC NULLS LAST, usd_to_idr DESC NULLS LAST LIMIT 1)
         AS latest_usd_to_idr
FROM fact GROUP BY trade_date"""

# --- keyword mentions (format with kws=tuple, by=column) ----------------------------
_WORDS = r"list_distinct(list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda w: w IN {kws}))"
CTE["keyword_mentions"] = ("WITH kw AS (SELECT unnest({kwlist}) AS keyword), "
                           "hits AS (SELECT unnest(" + _WORDS + ") AS keyword FROM documents) "
                           "SELECT kw.keyword, CAST(count(hits.keyword) AS BIGINT) AS mentions "
                           "FROM kw LEFT JOIN hits ON hits.keyword = kw.keyword GROUP BY kw.keyword")
CTE["keyword_mentions_by"] = ("SELECT {by}, keyword, CAST(count(*) AS BIGINT) AS mentions FROM "
                              "(SELECT {by}, unnest(" + _WORDS + ") AS keyword FROM documents) "
                              "GROUP BY {by}, keyword")

# --- nested keys -------------------------------------------------------------------
CTE["sanitize_keys_map"] = """SELECT l_orderkey, l_linenumber, 0 AS pos, l_returnflag || '_' || l_linestatus AS key,
       l_tax AS value FROM lineitem
UNION ALL
SELECT l_orderkey, l_linenumber, 1 AS pos, '_' || CAST(l_linenumber AS VARCHAR) || '_line' AS key,
       l_discount AS value FROM lineitem"""
CTE["sanitize_keys_struct"] = """SELECT o_orderkey AS order_key, o_orderpriority AS _1st_priority,
       o_totalprice AS total_price, o_custkey AS status_code_value, 1 AS status_fields FROM orders"""

# --- NDJSON --------------------------------------------------------------------------
CTE["ndjson_rows"] = """SELECT series_id, observation_date, observation_values, 5 AS n_keys FROM silver_fred"""


# --- back-fill --------------------------------------------------------------------------
from lodestone.plans.documents import PRIORITY_FEED, PRIORITY_FILE, SMALL_ORDER  # noqa: E402

_FEED_CASE = "CASE " + " ".join(
    "WHEN " + " OR ".join(f"contains(old_key, '{p}')" for p in pats) + f" THEN '{feed}'"
    for feed, pats in config.FEED_PATTERNS) + " END"

CTE["backfill_manifest"] = f"""listing AS (
  SELECT layer,
         CASE WHEN o_orderstatus = 'P'
              THEN layer || '/' || {_case('o_orderpriority', PRIORITY_FEED)} || '/ingested_at='
                   || strftime(o_orderdate, '%Y-%m-%d') || '/data' || ext
              ELSE layer || '/' || ts || '/' || {_case('o_orderpriority', PRIORITY_FILE)} || '-' || ts || '-'
                   || CAST(o_orderkey AS VARCHAR) || ext END AS old_key,
         CASE WHEN layer = 'bronze' THEN o_totalprice >= {SMALL_ORDER} END AS content_ok
  FROM (SELECT *, CASE WHEN o_orderstatus = 'F' THEN 'silver' ELSE 'bronze' END AS layer,
               strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS ts,
               CASE WHEN o_orderstatus = 'F' THEN CASE WHEN o_totalprice < {SMALL_ORDER} THEN '.csv' ELSE '.parquet' END
                    ELSE '.json' END AS ext
        FROM orders)),
classified AS (
  SELECT layer, old_key, {_FEED_CASE} AS feed,
         NULLIF(split_part(split_part(old_key, '/', 2), ' ', 1), '') AS ingest_day, content_ok
  FROM listing),
outcomes AS (
  SELECT layer, old_key, feed, ingest_day, TRY_CAST(ingest_day AS DATE) IS NOT NULL AS day_is_date,
         CASE WHEN contains(old_key, 'ingested_at=') THEN 'already_partitioned'
              WHEN ends_with(old_key, '/') THEN 'folder'
              WHEN layer = 'silver' AND NOT ends_with(old_key, '.parquet') THEN 'not_parquet'
              WHEN feed IS NULL THEN 'unclassified'
              WHEN ingest_day IS NULL THEN 'failed'
              WHEN layer = 'bronze' AND NOT content_ok THEN 'failed'
              ELSE 'migrated' END AS outcome
  FROM classified),
keyed AS (
  SELECT *, CASE WHEN outcome = 'migrated' THEN layer || '/' || feed || '/ingested_at=' || ingest_day END AS new_key
  FROM outcomes),
manifest AS (
  SELECT k.*, coalesce(w.winner_key = k.old_key, false) AS is_winner
  FROM keyed k LEFT JOIN (SELECT new_key, max(old_key) AS winner_key FROM keyed WHERE outcome = 'migrated'
                          GROUP BY new_key) w ON w.new_key = k.new_key)"""

CTE["backfill_summary"] = """SELECT layer, CAST(count(*) AS BIGINT) AS n_listed, """ + ", ".join(
    f"CAST(sum(CASE WHEN outcome = '{o}' THEN 1 ELSE 0 END) AS BIGINT) AS n_{o}"
    for o in ("migrated", "failed", "unclassified", "already_partitioned", "folder", "not_parquet")) + """,
       true AS listing_complete,
       sum(CASE WHEN outcome = 'failed' THEN 1 ELSE 0 END) = 0 AND sum(CASE WHEN outcome = 'unclassified' THEN 1 ELSE 0 END) = 0
         AND sum(CASE WHEN outcome = 'migrated' THEN 1 ELSE 0 END) > 0 AS ok_to_delete
FROM manifest GROUP BY layer"""

CTE["silver_roundtrip"] = """SELECT series_id, CAST(observation_date AS DATE) AS observation_date,
       observation_values, units, CAST(ingested_at AS DATE) AS event_timestamp
FROM flat_fred WHERE observation_values IS NULL OR observation_values > 0"""

CTE["silver_roundtrip_news"] = """SELECT CAST(l_shipdate AS TIMESTAMP) AS news_timestamp, l_returnflag || l_linestatus AS topics,
       CAST(4 AS BIGINT) AS total_mentions, 'ok' AS status, CAST(l_shipdate AS DATE) AS event_timestamp
FROM (SELECT *, l_orderkey * 8 + l_linenumber AS n FROM lineitem) WHERE n % 13 <> 0 AND n % 17 <> 0 AND n % 19 <> 0"""

CTE["gather_news_documents"] = f"""SELECT strftime(d, '%Y-%m-%d') AS ingested_at, count(*) AS n_keys,
       CAST(sum(total) AS BIGINT) AS total_mentions
FROM (SELECT CAST(l_shipdate AS DATE) AS d, l_returnflag || l_linestatus AS sym,
             sum(CAST(trunc(l_quantity) AS BIGINT)) AS total
      FROM lineitem GROUP BY 1, 2)
GROUP BY d HAVING count(*) = {len(DEMO_SYMBOLS)}"""

CTE["metal_units"] = "SELECT unit, count(*) AS n_rows FROM stg_metal_prices GROUP BY unit"

CTE["completeness_check"] = "SELECT load_day, n_present, missing FROM (\n  SELECT d.event_timestamp AS load_day, " \
    "CAST(count(DISTINCT f.series_id) AS BIGINT) AS n_present,\n" \
    "         (SELECT string_agg(s, ',' ORDER BY s) FROM (SELECT unnest(" + repr(list(config.FRED_SERIES)) + ") AS s) " \
    "WHERE s NOT IN (SELECT series_id FROM stg_fred_data x WHERE x.event_timestamp = d.event_timestamp)) AS missing\n" \
    "  FROM (SELECT DISTINCT event_timestamp FROM stg_fred_data) d\n" \
    "  JOIN stg_fred_data f ON f.event_timestamp = d.event_timestamp\n" \
    "  GROUP BY d.event_timestamp) WHERE missing IS NOT NULL"
