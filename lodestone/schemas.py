"""Schemas of every layer, as Spark DDL strings and StructTypes.

Silver columns keep the reference's string-typed datetimes; staging casts
them. Dynamic keys (metal names, currency codes, series ids, keywords) are
always parsed as MapType so a new key never changes a schema.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

# Wire documents (bronze), one JSON object per feed and day.
METAL_DOC = "status string, currency string, unit string, metals map<string,string>, timestamps map<string,string>"
CURRENCY_DOC = "date string, base string, rates map<string,string>"
# Macro and news documents are parsed in two steps (outer map first) so that a
# badly typed series or keyword rejects only its own rows.
FRED_DOC_OUTER = "map<string,string>"
FRED_SERIES_DOC = "units string, observations array<struct<date:string,value:string>>"
NEWS_DOC = "map<string,map<string,string>>"

# Silver tables; `ingested_at` is the partition column (string, yyyy-MM-dd).
SILVER = {
    "metal": "event_timestamp string, metal_symbol string, price_usd double, currency_base string, unit string",
    "currency": "rate_date string, currency_code string, exchange_rate double, base_currency string",
    "fred": "series_id string, observation_date string, observation_values double, units string",
    "news": "news_timestamp string, keywords string, total_mentions bigint, status string",
}
PARTITION_COLUMN = "ingested_at"
# VAL-15: the load instant (UTC) is written into the files as ``loaded_at``;
# the reference's model field of the same meaning collides with the partition.
LOAD_INSTANT = "loaded_at timestamp"

# Staging outputs.
STAGING = {
    "metal": "trade_date date, commodity_code string, price_usd double, unit string, event_timestamp timestamp_ntz",
    "currency": "rate_date date, currency_code string, exchange_rate double, base_currency string, event_timestamp date",
    "fred": "series_id string, observation_date date, observation_values double, units string, event_timestamp date",
    "news": "news_timestamp timestamp_ntz, topics string, total_mentions bigint, status string, event_timestamp date",
}

# Fact table, in output order (partition column last).
FACT = (
    "commodity_code string, price_usd_per_gr double, usd_to_idr double, price_idr_per_gr double, "
    "news_hype_count bigint, yield_10y double, usd_index double, cpi_index double, trade_date date"
)


def struct(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def silver_with_partition(feed: str) -> StructType:
    return struct(SILVER[feed] + f", {LOAD_INSTANT}, {PARTITION_COLUMN} string")


def column_names(ddl: str) -> list[str]:
    return [f.name for f in struct(ddl).fields]
