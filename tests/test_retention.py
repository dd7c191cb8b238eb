"""Old mart builds expire without catching a reader (SRC-12)."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from lodestone.plans import daily, retention
from lodestone.plans.retention import close_mart, expire_builds, open_mart
from tests.conftest import rows

DAY = dt.timedelta(days=1)


def build(spark, path, price):
    fact = spark.createDataFrame([("gold", price, 1.0, price, 0, None, None, None, dt.date(2026, 4, 8))], daily.schemas.FACT)
    return os.path.basename(daily.write_mart(fact, path))


def prices(df):
    return [r[0] for r in rows(df, "price_usd_per_gr")]


def folders(path):
    return sorted(f for f in os.listdir(path) if f.startswith("build-"))


def test_superseded_builds_expire_after_the_grace_period(spark, tmp_dir):
    one, two, three = (build(spark, tmp_dir, p) for p in (1.0, 2.0, 3.0))
    now = dt.datetime.now(dt.UTC)
    assert expire_builds(spark, tmp_dir, now=now) == {"retired": [], "deleted": [], "leased": []}
    assert expire_builds(spark, tmp_dir, keep=2, now=now + 3 * DAY)["deleted"] == [one]
    assert expire_builds(spark, tmp_dir, now=now + 3 * DAY)["deleted"] == [two]
    assert folders(tmp_dir) == [three] and prices(open_mart(spark, tmp_dir)[0]) == [3.0]


def test_a_reader_keeps_its_build(spark, tmp_dir):
    old = build(spark, tmp_dir, 1.0)
    now = dt.datetime.now(dt.UTC)
    df, reader = open_mart(spark, tmp_dir, lease=10 * DAY, now=now)
    build(spark, tmp_dir, 2.0)
    assert expire_builds(spark, tmp_dir, now=now + 3 * DAY) == {"retired": [old], "deleted": [], "leased": [old]}
    assert prices(df) == [1.0] and prices(open_mart(spark, tmp_dir, now=now + 3 * DAY)[0]) == [2.0]
    close_mart(spark, tmp_dir, reader, now=now + 4 * DAY)
    assert expire_builds(spark, tmp_dir, now=now + 5 * DAY)["deleted"] == [old]


def test_a_lease_ends_by_itself(spark, tmp_dir):
    old = build(spark, tmp_dir, 1.0)
    now = dt.datetime.now(dt.UTC)
    open_mart(spark, tmp_dir, lease=DAY, now=now)
    build(spark, tmp_dir, 2.0)
    assert expire_builds(spark, tmp_dir, now=now + 3 * DAY)["deleted"] == [old]


@pytest.mark.parametrize("step", ["leases", "deleted"])
def test_crash_between_steps_is_taken_up(spark, tmp_dir, monkeypatch, step):
    """The run ends after retiring (before the leases are read), or after deleting (before it is recorded)."""
    old, new = build(spark, tmp_dir, 1.0), build(spark, tmp_dir, 2.0)
    now = dt.datetime.now(dt.UTC)

    def crash(*a):
        raise KeyboardInterrupt

    write = retention._append
    if step == "leases":
        monkeypatch.setattr(retention, "leased", crash)
    else:
        monkeypatch.setattr(retention, "_append", lambda s, p, name, *a: crash() if name == "deleted" else write(s, p, name, *a))
    with pytest.raises(KeyboardInterrupt):
        expire_builds(spark, tmp_dir, now=now + 3 * DAY)
    monkeypatch.undo()
    assert prices(open_mart(spark, tmp_dir, now=now + 3 * DAY)[0]) == [2.0]  # the retired build is offered to nobody
    got = expire_builds(spark, tmp_dir, now=now + 3 * DAY)
    assert got["retired"] == [] and got["deleted"] == [old] and folders(tmp_dir) == [new]
    assert expire_builds(spark, tmp_dir, now=now + 4 * DAY)["deleted"] == []


def test_reader_between_the_steps_of_an_expiry(spark, tmp_dir, monkeypatch):
    """A build that is retired after the reader chose it and before it leased it is left alone by the reader."""
    old = build(spark, tmp_dir, 1.0)
    write = retention._append

    def late(s, path, name, schema, new):
        if name == "leases" and new[0][0] == old:
            build(spark, tmp_dir, 2.0)
            write(s, path, "retired", retention.RETIRED, [(old, new[0][3])])
        write(s, path, name, schema, new)
    monkeypatch.setattr(retention, "_append", late)
    assert prices(open_mart(spark, tmp_dir)[0]) == [2.0]


def test_failed_build_and_empty_mart(spark, tmp_dir):
    with pytest.raises(retention.NoBuild):
        open_mart(spark, tmp_dir)
    spark.range(1).withColumn("trade_date", F.lit("2026-04-08")).write.parquet(os.path.join(tmp_dir, "build-dead"))
    kept = build(spark, tmp_dir, 1.0)
    assert expire_builds(spark, tmp_dir)["deleted"] == []
    assert expire_builds(spark, tmp_dir, now=dt.datetime.now(dt.UTC) + 3 * DAY)["deleted"] == ["build-dead"]
    assert folders(tmp_dir) == [kept]
