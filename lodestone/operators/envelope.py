"""Document envelope checks and request windows (ENV-1..6, ENV-8).

A bronze frame has one row per document: ``ingested_at`` (load day) and
``value`` (the JSON text). ``check_envelope`` adds ``envelope_error``
(null when the document may be flattened) so bad documents go to a reject
frame instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone import config


def clean_domain(values: Sequence[str], what: str = "domain") -> tuple[str, ...]:
    """ENV-3 / T-21: drop empty entries; an empty list is an error, not zero rows."""
    if isinstance(values, str) or not isinstance(values, (list, tuple)):
        raise ValueError(f"{what} must be a non-empty list")
    out = tuple(v for v in values if v)
    if not out:
        raise ValueError(f"{what} must be a non-empty list")
    return out


def domain_array(values: Sequence[str]) -> Column:
    """A configured list as an array literal; exploding it multiplies each
    document by the (small, fixed) list without any join."""
    return F.array(*[F.lit(v) for v in clean_domain(values)])


def _top_level(value: Column) -> Column:
    return F.from_json(value, "map<string,string>")


def check_envelope(docs: DataFrame, feed: str, domain: Sequence[str] | None = None,
                   complete: bool = False) -> DataFrame:
    """ENV-1 empty body or empty object; not JSON; ENV-2 metal status;
    ENV-4 (``complete=True``, at landing) every configured series or keyword present.

    Adds ``envelope_error`` and ``top`` (the document's top level as
    map<string,string>, parsed once and reused by the checks and by the
    macro flattener)."""
    parsed = docs.withColumn("top", _top_level(F.col("value")))
    top = F.col("top")
    err = (F.when(F.coalesce(F.length(F.trim("value")), F.lit(0)) == 0, F.lit("empty"))
           .when(top.isNull(), F.lit("not_json"))
           .when(F.size(top) == 0, F.lit("empty_object")))
    if feed == "metal":
        err = err.when(F.coalesce(top.getItem("status") != config.METAL_STATUS_OK, F.lit(True)),
                       F.lit("status"))
    if complete and feed in ("fred", "news"):
        wanted = domain_array(domain or (config.FRED_SERIES if feed == "fred" else config.NEWS_KEYWORDS))
        err = err.when(F.size(F.array_except(wanted, F.map_keys(top))) > 0, F.lit("incomplete"))
    return parsed.withColumn("envelope_error", err)


def accepted_documents(docs: DataFrame, feed: str, domain: Sequence[str] | None = None,
                       complete: bool = False) -> DataFrame:
    """Documents with their parsed ``top`` and an ``accepted`` flag.

    Deliberately not a filter: Catalyst would push ``envelope_error IS NULL``
    below the projections and inline the JSON parse into it several times.
    The flatteners gate their ``explode`` on the flag instead, so a rejected
    document yields no rows and the parse runs once per document."""
    checked = check_envelope(docs, feed, domain, complete)
    return checked.withColumn("accepted", F.col("envelope_error").isNull()).drop("envelope_error")


def gated(docs: DataFrame, items: Column) -> Column:
    """``items`` for accepted documents, null (so no exploded rows) otherwise."""
    return F.when(F.col("accepted"), items) if "accepted" in docs.columns else items


def lookback_days(series: Column) -> Column:
    expr = F.lit(config.DEFAULT_LOOKBACK_DAYS)
    for s, days in config.LOOKBACK_DAYS.items():
        expr = F.when(series == s, F.lit(days)).otherwise(expr)
    return expr


def lookback_window(df: DataFrame, series_col: str, date_col: str, run_date) -> DataFrame:
    """ENV-5: keep observations in [run_date - look-back(series), run_date]."""
    run = F.to_date(F.lit(run_date)) if isinstance(run_date, str) else run_date
    d = F.col(date_col).cast("date")
    return df.where(d.between(F.date_sub(run, lookback_days(F.col(series_col))), run))


def news_window(df: DataFrame, date_col: str, run_date) -> DataFrame:
    """ENV-6: yesterday to today, both ends included."""
    run = F.to_date(F.lit(run_date)) if isinstance(run_date, str) else run_date
    return df.where(F.col(date_col).cast("date").between(F.date_sub(run, config.NEWS_WINDOW_DAYS), run))


def stamp_load_date(df: DataFrame, run_date: str) -> DataFrame:
    """ENV-8: the partition value is the run date, an explicit job argument."""
    return df.withColumn("ingested_at", F.lit(run_date))
