"""Driver contract: entry(), queries(), oracle_sql()."""

import re

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

# the training-data operators have tests of their own
CORE = sorted(n for n in E.queries() if not re.match(r"op\d+_|pipeline$", n))


def test_entry_schema(spark):
    df = E.entry(spark)
    assert df.columns == ["commodity_code", "price_usd_per_gr", "usd_to_idr", "price_idr_per_gr",
                          "news_hype_count", "yield_10y", "usd_index", "cpi_index", "trade_date"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(CORE) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", CORE)
def test_query_runs_on_smallest_tables(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    assert len(df.columns) == len(set(df.columns))
    assert df.count() >= 0
