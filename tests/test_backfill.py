"""Back-fill of the old layout (MIG-1..10)."""

import decimal
import json
import os

import pyarrow as pa
import pyarrow.parquet as pq

from pyspark.sql import functions as F

from lodestone.operators import backfill
from lodestone.plans import oldtree
from lodestone.plans.oldtree import damage
from lodestone.sources.bronze import read_bronze
from tests.conftest import rows

LISTING = [
    ("bronze", "bronze/2026-04-08 08:00:00/metal_prices-2026-04-08 08:00:00.json", '{"v": 1}'),
    ("bronze", "bronze/2026-04-08 10:00:00/metal_prices-2026-04-08 10:00:00.json", '{"v": 2}'),
    ("bronze", "bronze/2026-04-08 11:00:00/news_data-2026-04-08 11:00:00.json", "{broken"),
    ("bronze", "bronze/metal/ingested_at=2026-04-01/data.json", '{"v": 0}'),
    ("bronze", "bronze/2026-04-08 09:00:00/", None),
    ("bronze", "bronze/2026-04-08 09:00:00/other-2026-04-08.json", '{"v": 3}'),
    ("bronze", "bronze/fred_data.json", '{"v": 4}'),                       # second segment is the file
    ("bronze", "bronze/ 09:00/fred_data.json", '{"v": 5}'),                # empty day text
    ("silver", "silver/2026-04-08 08:00:00/currency_rates-2026-04-08 08:00:00.parquet", None),
    ("silver", "silver/2026-04-08 08:00:00/currency_rates-2026-04-08 08:00:00.csv", None),
]


def test_manifest_outcomes(spark):
    df = spark.createDataFrame(LISTING, "layer string, old_key string, content string")
    m = backfill.manifest(df)
    got = {r["old_key"]: (r["outcome"], r["new_key"], r["is_winner"]) for r in m.collect()}
    k = [x[1] for x in LISTING]
    assert got[k[0]] == ("migrated", "bronze/metal/ingested_at=2026-04-08", False)
    assert got[k[1]] == ("migrated", "bronze/metal/ingested_at=2026-04-08", True)   # last write wins
    assert got[k[2]][0] == "failed"                     # bad JSON
    assert got[k[3]][0] == "already_partitioned"
    assert got[k[4]][0] == "folder"
    assert got[k[5]][0] == "unclassified"
    assert got[k[6]] == ("migrated", "bronze/fred/ingested_at=fred_data.json", True)  # not checked (parity)
    assert got[k[7]][0] == "failed"
    assert got[k[8]] == ("migrated", "silver/currency/ingested_at=2026-04-08", True)
    assert got[k[9]][0] == "not_parquet"
    s = {r["layer"]: r for r in backfill.summary(m).collect()}
    assert s["bronze"]["n_migrated"] == 3 and s["bronze"]["n_failed"] == 2 and not s["bronze"]["ok_to_delete"]
    assert s["silver"]["n_migrated"] == 1 and s["silver"]["ok_to_delete"]
    # T-12: only migrated objects are delete candidates
    assert {r["old_key"] for r in backfill.delete_candidates(m).collect()} == {k[0], k[1], k[6], k[8]}


def test_run_backfill_on_files(spark, tmp_dir):
    # Hadoop paths cannot hold ':' in a file name, so the hours use '-' here.
    def put(key, text):
        p = os.path.join(tmp_dir, key)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "w") as f:
            f.write(text)

    put("bronze/2026-04-08 08-00-00/metal_prices-2026-04-08 08-00-00.json", '{"status": "success", "v": 1}\n')
    put("bronze/2026-04-08 10-00-00/metal_prices-2026-04-08 10-00-00.json", '{"status": "success", "v": 2}\n')
    put("bronze/2026-04-08 11-00-00/news_data-2026-04-08 11-00-00.json", "{broken")
    put("silver/2026-04-08 08-00-00/notes.txt", "x")
    sdir = os.path.join(tmp_dir, "silver/2026-04-08 08-00-00")
    pq.write_table(pa.table({"rate_date": ["2026-04-08T00:00:00"], "currency_code": ["IDR"],
                             "exchange_rate": [16000.0], "base_currency": ["USD"]}),
                   os.path.join(sdir, "currency_rates-2026-04-08 08-00-00.parquet"))
    man = backfill.run_backfill(spark, tmp_dir)
    outcomes = sorted(r["outcome"] for r in man.collect())
    assert outcomes == ["failed", "migrated", "migrated", "migrated", "not_parquet"]
    metal = read_bronze(spark, os.path.join(tmp_dir, "bronze/metal"))
    assert [json.loads(r["value"]) for r in metal.collect()] == [{"status": "success", "v": 2}]
    assert rows(metal, "ingested_at") == [("2026-04-08",)]
    cur = spark.read.parquet(os.path.join(tmp_dir, "silver/currency"))
    assert rows(cur, "currency_code", "exchange_rate") == [("IDR", 16000.0)]
    assert os.path.isdir(os.path.join(tmp_dir, "silver/currency/ingested_at=2026-04-08"))


def put_table(root, key, **columns):
    p = os.path.join(root, key)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    pq.write_table(pa.table(columns), p)


def test_backfill_loses_nothing(spark, tmp_dir):
    """A feed named only by its folder, an extra column, an unreadable file, and the gate."""
    put_table(tmp_dir, "silver/2026-04-08 08-00-00/currency/part-0.parquet", rate_date=["a"], exchange_rate=[1.0], extra=["kept"])
    put_table(tmp_dir, "silver/2026-04-09 08-00-00/currency_rates.parquet", rate_date=["b"], exchange_rate=[2.0])
    os.makedirs(os.path.join(tmp_dir, "bronze/2026-04-08 08-00-00"))
    with open(os.path.join(tmp_dir, "bronze/2026-04-08 08-00-00/metal_prices.json"), "w") as f:
        f.write('{"v": 1}')
    man = backfill.run_backfill(spark, tmp_dir)
    cur = spark.read.option("mergeSchema", "true").parquet(os.path.join(tmp_dir, "silver/currency"))
    assert rows(cur, "rate_date", "extra") == [("a", "kept"), ("b", None)]
    gate = {r["layer"]: r["ok_to_delete"] for r in backfill.summary(man, backfill.listing_complete(spark, tmp_dir, man)).collect()}
    assert gate == {"bronze": True, "silver": True}
    for r in man.where("outcome = 'migrated'").collect():
        assert os.path.isdir(os.path.join(tmp_dir, r["new_key"]))
    # an object that came after the listing shuts the gate
    put_table(tmp_dir, "silver/2026-04-10 08-00-00/currency_rates.parquet", rate_date=["c"])
    late = {r["layer"]: r["ok_to_delete"] for r in backfill.summary(man, backfill.listing_complete(spark, tmp_dir, man)).collect()}
    assert late == {"bronze": True, "silver": False}


def test_unreadable_silver_file_is_failed(spark, tmp_dir):
    put_table(tmp_dir, "silver/2026-04-08 08-00-00/currency_rates.parquet", rate_date=["a"])
    os.makedirs(os.path.join(tmp_dir, "bronze"))
    bad = os.path.join(tmp_dir, "silver/2026-04-09 08-00-00/currency_rates.parquet")
    os.makedirs(os.path.dirname(bad))
    with open(bad, "w") as f:
        f.write("not parquet")
    man = backfill.run_backfill(spark, tmp_dir)
    assert rows(man, "outcome") == [("failed",), ("migrated",)]
    assert [r["ok_to_delete"] for r in backfill.summary(man).collect()] == [False]


def put_groups(root, key, n, per_group=100):
    """A file of several row groups; returns its path."""
    p = os.path.join(root, key)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    pq.write_table(pa.table({"rate_date": [f"d{i}-{'x' * (i % 37)}" for i in range(n)], "exchange_rate": [i * 0.5 for i in range(n)]}), p, row_group_size=per_group)
    return p


def test_half_damaged_file_is_failed_and_not_published(spark, tmp_dir):
    """A readable footer and first row groups, then damage: no half day, gate shut, and an earlier run's day does not hide it."""
    os.makedirs(os.path.join(tmp_dir, "bronze"))
    put_groups(tmp_dir, "silver/2026-04-08 08-00-00/currency_rates.parquet", 1000)
    bad = put_groups(tmp_dir, "silver/2026-04-09 08-00-00/currency_rates.parquet", 1000)
    put_groups(tmp_dir, "silver/2026-04-09 07-00-00/currency_rates.parquet", 10)  # not the winner of its day, rests on it
    out = os.path.join(tmp_dir, "new")
    put_groups(out, "silver/currency/ingested_at=2026-04-09/old.parquet", 5)  # of an earlier run
    damage(spark, bad)
    man, ledger = backfill.backfill_ledger(spark, tmp_dir, out)
    got = {r["ingest_day"]: (r["n_expected"], r["n_written"], r["is_proven"]) for r in ledger.collect()}
    assert got == {"2026-04-08": (1000, 1000, True), "2026-04-09": (1000, None, False)}
    read = {r["ingest_day"]: r["n_read"] for r in ledger.collect()}
    assert 0 < read["2026-04-09"] < 1000  # it was half readable
    assert sorted((r["old_key"][7:20], r["outcome"]) for r in man.collect()) == [
        ("2026-04-08 08", "migrated"), ("2026-04-09 07", "failed"), ("2026-04-09 08", "failed")]
    assert [r["ok_to_delete"] for r in backfill.summary(man).collect()] == [False]
    cur = spark.read.parquet(os.path.join(out, "silver/currency"))
    assert {str(r[0]): r[1] for r in cur.groupBy("ingested_at").count().collect()} == {"2026-04-08": 1000, "2026-04-09": 5}


def test_ledger_compares_contents(spark):
    """Equal counts with other contents are no proof; neither is a missing side."""
    one = ("silver", "currency", "2026-04-08", 2, 2, 2)
    rows_ = [(*one, 7, 7), (*one, 7, 8), (*one[:5], None, 7, None), ("bronze", "metal", "x", None, None, None, None, None)]
    df = spark.createDataFrame([(*r[:6], *[None if v is None else decimal.Decimal(v) for v in r[6:]]) for r in rows_], backfill.LEDGER)
    assert [r["is_proven"] for r in backfill.proven(df).collect()] == [True, False, False, False]


def test_backfill_of_empty_files_and_odd_days(spark, tmp_dir):
    """A file without rows is failed; a day text that is no date keeps its folder."""
    os.makedirs(os.path.join(tmp_dir, "bronze"))
    put_table(tmp_dir, "silver/2026-04-08 08-00-00/currency_rates.parquet", rate_date=pa.array([], pa.string()))
    put_table(tmp_dir, "silver/20=6%a 08-00-00/news_data.parquet", keywords=["a", None])
    man, ledger = backfill.backfill_ledger(spark, tmp_dir)
    assert sorted((r["ingest_day"], r["outcome"]) for r in man.collect()) == [("2026-04-08", "failed"), ("20=6%a", "migrated")]
    assert {r["ingest_day"]: r["n_written"] for r in ledger.collect()} == {"2026-04-08": None, "20=6%a": 2}


def test_damage_inside_a_page_is_failed_and_does_not_stop_the_others(spark, tmp_dir):
    """Indices into a dictionary that point beyond it decompress well and fail only where values are decoded."""
    os.makedirs(os.path.join(tmp_dir, "bronze"))
    for day in ("08", "09"):
        folder = os.path.join(tmp_dir, f"silver/2026-04-{day} 08-00-00/currency_rates")
        spark.range(0, 200_000, 1, 1).select(F.concat(F.lit("d"), F.xxhash64("id") % 300).alias("rate_date"), (F.xxhash64("id") % 350).cast("string").alias("currency_code")) \
            .write.parquet(folder)
    damage(spark, oldtree.one_file(spark, os.path.join(tmp_dir, "silver/2026-04-09 08-00-00/currency_rates")))
    _, ledger = backfill.backfill_ledger(spark, tmp_dir, os.path.join(tmp_dir, "new"))
    assert {r["ingest_day"]: (r["n_expected"], r["n_written"], r["is_proven"]) for r in ledger.collect()} == {
        "2026-04-08": (200_000, 200_000, True), "2026-04-09": (200_000, None, False)}


def test_old_files_have_few_row_groups(spark, tmp_dir):
    """The number of row groups does not grow with the file: readers parse the footer for every split."""
    sf, n = os.path.join(tmp_dir, "sf"), 120_000
    spark.range(n).select(F.expr("timestamp'1995-01-01' + make_interval(0, 0, 0, int(id % 700))").alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority"),
                          (F.xxhash64("id") / 1000).alias("o_totalprice")).write.parquet(f"{sf}/orders.parquet")
    assert oldtree.write_old_tree(spark, sf, f"{tmp_dir}/old") == [1995, 1996]
    for y in (1995, 1996):
        footer = pq.ParquetFile(oldtree.one_file(spark, f"{tmp_dir}/old/silver/{y}-01-01 {oldtree.HOUR}/currency_rates").removeprefix("file:").replace("%20", " ")).metadata
        assert 1 < footer.num_row_groups <= 40
        assert footer.num_rows == sum(1 for i in range(700) if (i < 365) == (y == 1995)) * (n // 700) + sum(1 for i in range(n % 700) if (i < 365) == (y == 1995))


def test_the_day_is_read_per_file(spark, tmp_dir):
    """Names are taken apart once a file: a filter on the day reaches the stored files and not the scan of the rows."""
    put_groups(tmp_dir, "silver/2026-04-08 08-00-00/currency_rates.parquet", 1000)
    path = f"{tmp_dir}/silver/2026-04-08 08-00-00/currency_rates.parquet"
    files = backfill.files_of(spark, [path], tmp_dir)
    plan = files.where("ingest_day IS NOT NULL")._jdf.queryExecution().optimizedPlan().toString()
    assert "parquet" not in plan.lower() and "Relation" not in plan
    rows_ = backfill.silver_rows(spark, [path], files, tolerant=False)
    assert {r[0]: r[1] for r in rows_.groupBy("ingested_at").count().collect()} == {"2026-04-08": 1000}
