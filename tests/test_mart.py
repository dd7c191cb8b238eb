"""Fact mart: golden example and the traps of SURVEY 2.15 (T-1, T-2, T-5, T-8, T-9, T-11)."""

import datetime as dt

import pytest

from lodestone.plans import dashboard, mart
from lodestone.schemas import STAGING, column_names
from tests.conftest import rows

D1, D2, D3, D4 = (dt.date(2026, 4, d) for d in (1, 2, 3, 4))
T = dt.datetime(2026, 4, 1, 10)


def frames(spark, fx_rows=None):
    metal = spark.createDataFrame([
        (D1, "gold", 100.0, "g", T), (D1, "silver", 10.0, "g", T),
        (D2, "gold", 110.0, "g", T), (D3, "gold", 120.0, "g", T),
    ], STAGING["metal"])
    fx = spark.createDataFrame(fx_rows if fx_rows is not None else [
        (D1, "IDR", 16000.0, "USD", D1), (D2, "IDR", 16100.0, "USD", D2), (D2, "EUR", 0.9, "USD", D2),
        (D4, "IDR", 16500.0, "USD", D4),                       # T-9: a later rate exists
    ], STAGING["currency"])
    fred = spark.createDataFrame([
        ("DGS10", D1, 4.3, "lin", D1), ("DGS10", D2, 4.4, "lin", D2),
        ("DGS10", D2, 4.5, "lin", D3),                          # T-2: same day, newer load wins
        ("CPIAUCSL", D1, 300.0, "lin", D1), ("CPIAUCSL", D2, None, "lin", D2),  # T-5: newest is null
        ("OTHER", D4, 1.0, "lin", D4),
    ], STAGING["fred"])
    news = spark.createDataFrame([
        (T, "gold", 5, "ok", D1), (T, "gold", 7, "ok", D1), (T, "silver", 3, "ok", D2),
    ], STAGING["news"])
    return metal, fx, fred, news


EXPECTED = [
    ("gold", 100.0, 16000.0, 1600000.0, 12, 4.5, None, None, D1),
    ("gold", 110.0, 16100.0, 1771000.0, 0, 4.5, None, None, D2),
    ("gold", 120.0, 16500.0, 1980000.0, 0, 4.5, None, None, D3),   # T-9: fallback is the newest rate
    ("silver", 10.0, 16000.0, 160000.0, 0, 4.5, None, None, D1),   # T-11: no news -> 0
]


@pytest.mark.parametrize("bound", [1_000_000, 0])
def test_golden_fact_both_join_strategies(spark, bound):
    fact = mart.build_fact(*frames(spark), max_broadcast_rows=bound)
    assert fact.columns == column_names(
        "commodity_code string, price_usd_per_gr double, usd_to_idr double, price_idr_per_gr double, "
        "news_hype_count bigint, yield_10y double, usd_index double, cpi_index double, trade_date date")
    assert rows(fact, *fact.columns) == sorted(EXPECTED, key=repr)


def test_fx_fan_out_and_dedupe(spark):
    fx = [(D1, "IDR", 16000.0, "USD", D1), (D1, "IDR", 16050.0, "USD", D2), (D2, "IDR", 16100.0, "USD", D2)]
    m, _, f, n = frames(spark)
    fxd = spark.createDataFrame(fx, STAGING["currency"])
    fact = mart.build_fact(m, fxd, f, n)
    # T-8: two IDR rows for D1 duplicate both D1 metals
    assert fact.where("trade_date = DATE'2026-04-01'").count() == 4
    dedup = mart.build_fact(m, fxd, f, n, dedupe_rates=True)
    assert rows(dedup.where("trade_date = DATE'2026-04-01'"), "commodity_code", "usd_to_idr") == [
        ("gold", 16050.0), ("silver", 16050.0)]


def test_no_idr_row_empties_the_mart_unless_relaxed(spark):
    fx = [(D1, "EUR", 0.9, "USD", D1)]
    m, _, f, n = frames(spark)
    fxd = spark.createDataFrame(fx, STAGING["currency"])
    assert mart.build_fact(m, fxd, f, n).count() == 0            # T-1
    relaxed = mart.build_fact(m, fxd, f, n, strict=False)
    assert relaxed.count() == 4
    assert {r["usd_to_idr"] for r in relaxed.collect()} == {None}


def test_latest_per_key_methods_agree(spark):
    _, _, fred, _ = frames(spark)
    a = rows(mart.macro_latest(fred, method="aggregate"))
    w = rows(mart.macro_latest(fred, method="window"))
    assert a == w == [("CPIAUCSL", None), ("DGS10", 4.5)]


def test_pivot_over_no_rows_is_one_null_row(spark):
    _, _, fred, _ = frames(spark)
    p = mart.macro_pivot(fred.where("false"))
    assert [tuple(r) for r in p.collect()] == [(None, None, None)]


def test_dashboard_queries(spark):
    fact = mart.build_fact(*frames(spark))
    assert rows(dashboard.price_daily(fact), "trade_date", "commodity_code", "price_usd_per_gr")[0] == (
        D1, "gold", 100.0)
    usd = {r["trade_date"]: (r["avg_usd_to_idr"], r["latest_usd_to_idr"]) for r in dashboard.usd_idr(fact).collect()}
    assert usd[D1] == (16000.0, 16500.0) and usd[D3] == (16500.0, 16500.0)
    corr = {r["commodity_code"]: r["n_days"] for r in dashboard.news_price_corr(fact).collect()}
    assert corr == {"gold": 3, "silver": 1}
