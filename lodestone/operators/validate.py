"""Row validation with a reject output (VAL-1..14, FN-11).

Each feed has an ordered list of ``(rule_id, predicate)``; a null predicate
counts as a failure. One projection computes the typed silver columns and
the array of failed rule ids, so valid and rejected rows come from one scan:
``valid + rejected = input`` by construction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone import config
from lodestone.functions.casts import flexible_timestamp, safe_bigint, safe_double
from lodestone.functions.generators import explode_exact

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _positive(x: Column) -> Column:
    # NaN > 0 is true in Spark, so NaN is excluded explicitly (T-6).
    return (x > 0) & ~F.isnan(x)


def _present(*cols: str) -> Column:
    out = None
    for c in cols:
        p = F.col(c).isNotNull()
        out = p if out is None else out & p
    return out


def _iso(ts: Column) -> Column:
    return F.date_format(ts, ISO_MICROS)


def metal_spec():
    ts = flexible_timestamp("event_timestamp")
    price = safe_double("price_usd")
    rules = [
        ("VAL-1", ts.isNotNull()),
        ("VAL-2", F.length("metal_symbol") > 0),
        ("VAL-3", _positive(price)),
        ("VAL-4", _present("currency_base", "unit")),
    ]
    typed = {"event_timestamp": _iso(ts), "metal_symbol": F.col("metal_symbol"), "price_usd": price,
             "currency_base": F.col("currency_base"), "unit": F.col("unit")}
    return rules, typed


def currency_spec():
    ts = flexible_timestamp("rate_date")
    rate = safe_double("exchange_rate")
    rules = [
        ("VAL-5", ts.isNotNull()),
        ("VAL-7", _positive(rate)),
        ("VAL-8", _present("currency_code", "base_currency")),
    ]
    typed = {"rate_date": _iso(ts), "currency_code": F.col("currency_code"), "exchange_rate": rate,
             "base_currency": F.col("base_currency")}
    return rules, typed


def fred_spec():
    ts = flexible_timestamp("observation_date")
    raw = F.col("observation_values").cast("string")
    missing = raw.isNull() | (raw == ".")
    value = F.when(~missing, safe_double(raw))
    rules = [
        ("VAL-9", _present("series_id", "units") & ts.isNotNull()),
        ("VAL-11", missing | _positive(value)),
    ]
    typed = {"series_id": F.col("series_id"), "observation_date": _iso(ts), "observation_values": value,
             "units": F.col("units")}
    return rules, typed


def news_spec():
    ts = flexible_timestamp("news_timestamp")
    n = safe_bigint("total_mentions")
    rules = [
        ("VAL-12", n >= 0),
        ("VAL-13", F.col("status") == config.NEWS_STATUS_OK),
        ("VAL-14", _present("keywords") & ts.isNotNull()),
    ]
    typed = {"news_timestamp": _iso(ts), "keywords": F.col("keywords"), "total_mentions": n,
             "status": F.col("status")}
    return rules, typed


SPECS = {"metal": metal_spec, "currency": currency_spec, "fred": fred_spec, "news": news_spec}


def check(raw: DataFrame, feed: str) -> DataFrame:
    """Typed silver columns + ``ingested_at`` + ``reject_reasons`` (array of rule ids,
    empty when valid). Rows are never dropped here."""
    rules, typed = SPECS[feed]()
    # concat_ws skips the passed rules (nulls); no higher-order function, so the
    # predicates stay in generated code and share the parsed values with the
    # typed columns (common subexpressions).
    joined = F.concat_ws(",", *[F.when(~F.coalesce(p, F.lit(False)), F.lit(rid)) for rid, p in rules])
    failed = F.when(joined == "", F.array().cast("array<string>")).otherwise(F.split(joined, ","))
    return raw.select(*[c.alias(n) for n, c in typed.items()], F.col("ingested_at"),
                      failed.alias("reject_reasons"))


def split(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows in the silver contract, rejected rows with reasons)."""
    ok = F.size("reject_reasons") == 0
    return checked.where(ok).drop("reject_reasons"), checked.where(~ok)


def validate(raw: DataFrame, feed: str) -> tuple[DataFrame, DataFrame]:
    return split(check(raw, feed))


def reject_summary(checked: DataFrame, feed: str) -> DataFrame:
    """Rows per failed rule (a row failing two rules counts under both)."""
    return (explode_exact(checked, [], F.col("reject_reasons"), ["rule_id"])
            .groupBy("rule_id").agg(F.count("*").alias("n_rows"))
            .select(F.lit(feed).alias("feed"), "rule_id", "n_rows"))
