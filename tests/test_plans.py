"""Plan shape: what must hold at scale, checked with the physical plan."""

import re

import __spark_entry__ as E
from lodestone.plans import demo, mart
from tests.conftest import SF_SMALL


def plan(df):
    df.write.format("noop").mode("overwrite").save()   # run, so AQE shows the final plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_streams_fx_without_shuffle(spark):
    p = plan(E.queries()["fact_commodity_performance"](spark, SF_SMALL))
    assert "SortMergeJoin" not in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p   # no cross joins
    assert "BroadcastHashJoin" in p
    # the FX scan feeds the inner broadcast join directly: no exchange keyed on the rate date
    assert not re.search(r"Exchange hashpartitioning\(rate_date", p)


def test_fact_falls_back_to_shuffle_join_above_bound(spark):
    s = demo.staged_all(spark, SF_SMALL)
    big = mart.build_fact(s["metal"], s["currency"], s["fred"], s["news"], max_broadcast_rows=0)
    small = mart.build_fact(s["metal"], s["currency"], s["fred"], s["news"])
    assert sorted(map(tuple, big.collect())) == sorted(map(tuple, small.collect()))


def test_latest_per_key_combines_map_side(spark):
    q = E.queries()["macro_latest"](spark, SF_SMALL)
    p = q._jdf.queryExecution().executedPlan().toString()
    # a hash aggregate on (series, dates) runs before the sort aggregate on the struct
    assert p.count("HashAggregate") >= 2 and "SortAggregate" in p
    assert "Window" not in p


def test_keyword_split_is_not_duplicated_into_a_scan_filter(spark):
    q = E.queries()["keyword_mentions_words"](spark, SF_SMALL)
    p = q._jdf.queryExecution().optimizedPlan().toString()
    assert p.count("regexp_extract_all(") == 1


def test_silver_roundtrip_and_staging_prune_columns(spark):
    q = E.queries()["stg_currency_rates"](spark, SF_SMALL).select("rate_date")
    p = q._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz>" in p


def test_bounded_checks_rows_and_bytes(spark):
    from lodestone.operators.joins import bounded

    df = spark.range(100).selectExpr("id", "cast(id as string) as s")
    assert bounded(df, max_rows=100)[1] is True
    assert bounded(df, max_rows=99)[1] is False
    assert bounded(df, max_rows=1000, max_bytes=1000)[1] is False


def test_fact_reads_fx_twice_and_never_outer_joins_it(spark):
    from lodestone.plans import demo, mart

    s = demo.staged_all(spark, SF_SMALL)
    fx = s["currency"]
    out = mart.build_fact(s["metal"], fx, s["fred"], s["news"], max_broadcast_rows=0)
    p = out._jdf.queryExecution().executedPlan().toString()
    reads = p.count("o_orderpriority#") and p.count("FileScan parquet [o_orderdate")
    assert reads <= 1       # the other one has already run, into the per-date frame
    left = [line for line in p.splitlines() if "LeftOuter" in line]
    assert not any("rate_date" in line for line in left)


def test_fact_is_the_same_above_the_broadcast_bound(spark):
    from lodestone.plans import demo, mart

    s = demo.staged_all(spark, SF_SMALL)
    frames = (s["metal"], s["currency"], s["fred"], s["news"])
    for dedupe in (False, True):
        one, two = (sorted(map(tuple, mart.build_fact(*frames, dedupe_rates=dedupe, **kw).collect()), key=repr) for kw in ({}, {"max_broadcast_rows": 0}))
        assert one == two and one


def test_partition_window_prunes_folders(spark):
    p = E.queries()["partition_window"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingested_at" in p
