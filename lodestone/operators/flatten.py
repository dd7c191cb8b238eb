"""Bronze document -> raw rows, one per configured key (FLT-1..6, JSN-2/4/5, JOIN-5).

Documents are parsed with explicit schemas whose dynamic parts are maps, and
multiplied by the configured list through ``explode`` of an array literal;
a configured key missing from a document gives a row with null fields (the
reference's ``dict.get``), which validation then rejects. Output columns
are the raw strings of the wire form; typing happens in validation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone import config, schemas
from lodestone.functions.generators import explode_exact
from lodestone.operators.envelope import clean_domain, domain_array, gated


def _get(m: Column, key) -> Column:
    return F.try_element_at(m, key if isinstance(key, Column) else F.lit(key))


def flatten_metal(docs: DataFrame, metals: Sequence[str] = config.METALS) -> DataFrame:
    d = docs.select("ingested_at", F.from_json("value", schemas.METAL_DOC).alias("d"),
                    *(["accepted"] if "accepted" in docs.columns else []))
    rows = explode_exact(d, ["ingested_at", "d"], gated(docs, domain_array(metals)), ["metal_symbol"])
    return rows.select(
        _get(F.col("d.timestamps"), "metal").alias("event_timestamp"),
        F.col("metal_symbol"),
        _get(F.col("d.metals"), F.col("metal_symbol")).alias("price_usd"),
        F.col("d.currency").alias("currency_base"),
        F.col("d.unit").alias("unit"),
        F.col("ingested_at"),
    )


def flatten_currency(docs: DataFrame, currencies: Sequence[str] = config.CURRENCIES,
                     on_missing: str = "skip") -> DataFrame:
    """``on_missing="fail"`` reproduces T-4: a configured currency that is absent
    or not a number fails the whole job (``raise_error`` on the executor)."""
    from lodestone.functions.casts import safe_double

    d = docs.select("ingested_at", F.from_json("value", schemas.CURRENCY_DOC).alias("d"),
                    *(["accepted"] if "accepted" in docs.columns else []))
    rows = explode_exact(d, ["ingested_at", "d"], gated(docs, domain_array(currencies)), ["currency_code"])
    rate = _get(F.col("d.rates"), F.col("currency_code"))
    if on_missing == "fail":
        rate = F.when(safe_double(rate).isNull(),
                      F.raise_error(F.concat(F.lit("currency rate missing or not numeric: "),
                                             F.col("currency_code")))).otherwise(rate)
    elif on_missing != "skip":
        raise ValueError("on_missing must be 'skip' or 'fail'")
    return rows.select(
        F.col("d.date").alias("rate_date"),
        F.col("currency_code"),
        rate.alias("exchange_rate"),
        F.col("d.base").alias("base_currency"),
        F.col("ingested_at"),
    )


def flatten_fred(docs: DataFrame, series: Sequence[str] = config.FRED_SERIES) -> DataFrame:
    """Two-step parse: the outer object as map<string,string>, then each
    configured series on its own, so one badly typed series cannot null the
    whole document. Missing series or empty observations give no rows."""
    top = F.col("top") if "top" in docs.columns else F.from_json("value", schemas.FRED_DOC_OUTER)
    outer = explode_exact(docs, ["ingested_at"], gated(docs, top), ["series_id", "body"])
    outer = outer.where(F.col("series_id").isin(list(clean_domain(series))))
    parsed = outer.select("ingested_at", "series_id", F.from_json("body", schemas.FRED_SERIES_DOC).alias("s"))
    obs = explode_exact(parsed, ["ingested_at", "series_id", F.col("s.units").alias("units")],
                        F.col("s.observations"), ["o"])
    return obs.select(
        F.col("series_id"),
        F.col("o.date").alias("observation_date"),
        F.col("o.value").alias("observation_values"),
        F.col("units"),
        F.col("ingested_at"),
    )


def flatten_news(docs: DataFrame, keywords: Sequence[str] = config.NEWS_KEYWORDS,
                 news_timestamp=None) -> DataFrame:
    """Defaults fill only a *missing* key (T-14): no ``totalResults`` -> "0",
    no ``status`` -> "unknown"; a JSON null stays null and is rejected later.
    ``news_timestamp`` is the run instant (defaults to the load day)."""
    m = F.from_json("value", schemas.NEWS_DOC)
    rows = explode_exact(docs.select("ingested_at", m.alias("m"), *(["accepted"] if "accepted" in docs.columns else [])),
                         ["ingested_at", "m"], gated(docs, domain_array(keywords)), ["keywords"])
    inner = _get(F.col("m"), F.col("keywords"))

    def field(name: str, default: str) -> Column:
        present = F.coalesce(F.map_contains_key(inner, F.lit(name)), F.lit(False))
        return F.when(present, _get(inner, name)).otherwise(F.lit(default))

    ts = news_timestamp if news_timestamp is not None else F.concat(F.col("ingested_at"), F.lit("T00:00:00"))
    if isinstance(ts, str):
        ts = F.lit(ts)
    return rows.select(
        ts.alias("news_timestamp"),
        F.col("keywords"),
        field("totalResults", "0").alias("total_mentions"),
        field("status", config.NEWS_STATUS_DEFAULT).alias("status"),
        F.col("ingested_at"),
    )


FLATTENERS = {"metal": flatten_metal, "currency": flatten_currency, "fred": flatten_fred, "news": flatten_news}
