"""Silver tables: idempotent day overwrite, explicit schema, partition window (SRC-3..9)."""

import os

from pyspark.sql import functions as F

from lodestone import schemas
from lodestone.sources import silver
from tests.conftest import rows

ROW = "event_timestamp string, metal_symbol string, price_usd double, currency_base string, unit string, ingested_at string"


def metal(spark, day, prices):
    return spark.createDataFrame([("2026-04-08T01:00:00", s, p, "USD", "g", day) for s, p in prices], ROW)


def test_day_rerun_replaces_only_that_day(spark, tmp_dir):
    path = os.path.join(tmp_dir, "silver", "metal")
    silver.write_silver(metal(spark, "2026-04-07", [("gold", 1.0)]), path, "metal")
    silver.write_silver(metal(spark, "2026-04-08", [("gold", 2.0), ("silver", 3.0)]), path, "metal")
    silver.write_silver(metal(spark, "2026-04-08", [("gold", 4.0)]), path, "metal")   # re-run of a day
    silver.write_silver(metal(spark, "2026-04-08", [("gold", 4.0)]), path, "metal")   # idempotent
    back = silver.read_silver(spark, path, "metal")
    assert rows(back, "ingested_at", "metal_symbol", "price_usd") == [
        ("2026-04-07", "gold", 1.0), ("2026-04-08", "gold", 4.0)]
    assert dict(back.dtypes)["ingested_at"] == "string"      # not inferred as a date
    # one file per day
    day_files = [f for f in os.listdir(os.path.join(path, "ingested_at=2026-04-08")) if f.endswith(".parquet")]
    assert len(day_files) == 1


def test_empty_frame_keeps_previous_data(spark, tmp_dir):
    path = os.path.join(tmp_dir, "silver", "metal")
    silver.write_silver(metal(spark, "2026-04-08", [("gold", 2.0)]), path, "metal")
    silver.write_silver(metal(spark, "2026-04-08", [("gold", 2.0)]).where("false"), path, "metal")  # FLT-9
    assert silver.read_silver(spark, path, "metal").count() == 1


def test_partition_window_prunes_directories(spark, tmp_dir):
    path = os.path.join(tmp_dir, "silver", "metal")
    for day in ("2025-12-31", "2026-01-01", "2026-02-01"):
        silver.write_silver(metal(spark, day, [("gold", 1.0)]), path, "metal")
    df = silver.partition_window(silver.read_silver(spark, path, "metal"), "2026-01-15")
    assert rows(df, "ingested_at") == [("2026-01-01",)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "ingested_at" in plan


def test_filter_reaches_the_scan(spark, tmp_dir):
    path = os.path.join(tmp_dir, "silver", "currency")
    fx = spark.createDataFrame([("2026-04-08", "IDR", 16000.0, "USD", "2026-04-08")],
                               "rate_date string, currency_code string, exchange_rate double, base_currency string, ingested_at string")
    silver.write_silver(fx, path, "currency")
    q = silver.read_silver(spark, path, "currency").where(F.col("currency_code") == "IDR").select("exchange_rate")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(currency_code), EqualTo(currency_code,IDR)]" in plan
    assert "ReadSchema: struct<currency_code:string,exchange_rate:double>" in plan


def test_catalog_table(spark, tmp_dir):
    path = os.path.join(tmp_dir, "silver", "metal")
    silver.write_silver(metal(spark, "2026-04-08", [("gold", 2.0)]), path, "metal")
    silver.register_table(spark, "commodity_staged_test", "metal_prices", path, "metal")
    assert spark.table("commodity_staged_test.metal_prices").count() == 1
    spark.sql("DROP TABLE commodity_staged_test.metal_prices")


def test_row_counter_is_observed(spark):
    df, obs = silver.count_rows(metal(spark, "2026-04-08", [("gold", 1.0), ("silver", 2.0)]))
    df.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == 2


def test_load_instant_is_written(spark, tmp_dir):
    path = os.path.join(tmp_dir, "silver", "metal")
    silver.write_silver(metal(spark, "2026-04-08", [("gold", 2.0)]), path, "metal")
    r = silver.read_silver(spark, path, "metal").first()
    assert r["loaded_at"] is not None and r["ingested_at"] == "2026-04-08"


def test_days_are_computed_not_listed(spark, tmp_dir):
    """Absent days have no rows; folders that a listing would stumble over are not seen."""
    path = os.path.join(tmp_dir, "metal")
    days = ("2025-12-31", "2026-01-01", "2026-01-03", "2026-02-01")
    df = spark.createDataFrame([("t", "gold", 1.0 * k, "USD", "g", d) for k, d in enumerate(days)], schemas.SILVER["metal"] + ", ingested_at string")
    silver.write_silver(df, path, "metal")
    for stray in ("ingested_at=notes", "ingested_at=2026-03-01/hour=1", "other"):
        os.makedirs(os.path.join(path, stray))
        with open(os.path.join(path, stray, "x.parquet"), "w") as f:
            f.write("not parquet")
    got = silver.read_days(spark, path, "metal", "2026-01-01", "2026-02-28")
    assert rows(got, "ingested_at", "price_usd") == [("2026-01-01", 1.0), ("2026-01-03", 2.0), ("2026-02-01", 3.0)]
    files = got.inputFiles()
    assert len(files) == 3 and not any("notes" in f or "2025" in f for f in files)
    assert silver.read_days(spark, path, "metal", "2027-01-01", "2027-02-28").count() == 0
    assert silver.read_days(spark, path, "metal", "2026-02-01", "2026-01-01").count() == 0
    assert silver.calendar("2026-02-27", "2026-03-01") == ["2026-02-27", "2026-02-28", "2026-03-01"]


def test_catalog_knows_days_in_batches(spark, tmp_dir):
    path = os.path.join(tmp_dir, "news")
    df = spark.createDataFrame([("t", "gold", k, "ok", f"2026-01-{k:02d}") for k in range(1, 8)], schemas.SILVER["news"] + ", ingested_at string")
    silver.write_silver(df, path, "news")
    name = "days_" + os.path.basename(tmp_dir).replace("-", "_").lower()
    silver.register_table(spark, "commodity_staged_test", name, path, "news", end="2026-01-05")
    t = f"commodity_staged_test.{name}"
    assert spark.table(t).count() == 5
    silver.add_days(spark, t, path, [f"2026-01-{k:02d}" for k in range(4, 8)], batch=2)
    assert spark.table(t).count() == 7
    assert spark.sql(f"SHOW PARTITIONS {t}").count() == 7
    spark.sql(f"DROP TABLE {t}")
