"""Expiry of old mart builds that no reader can be caught by (SRC-12).

A mart is a folder of build folders with small append-only tables beside
them: ``builds`` (complete builds, ``plans.daily.write_mart``), ``leases``
(who reads which build until when), ``retired`` and ``deleted``. The newest
row about a build counts, nothing is changed in place.

A reader takes a lease and then looks whether the build was retired; the
expiry retires a build and then looks for leases. Whichever comes second
sees the other, so a build is deleted only when nobody can be reading it. Every step
can be the last before a crash: a build that is retired and not deleted is
taken up by the next run, and a folder without a row in ``builds`` (a build that
failed) is retired when it is older than the grace period.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.plans.daily import BUILDS, read_fact

LEASES = "build string, reader string, until timestamp, at timestamp"
RETIRED = "build string, retired_at timestamp"
DELETED = "build string, deleted_at timestamp"


def _now() -> dt.datetime:
    return dt.datetime.now(dt.UTC)


def _files(spark: SparkSession, path: str):
    jvm, conf = spark._jvm, spark._jsparkSession.sparkContext().hadoopConfiguration()
    make = jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(conf), make


def table(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    """One of the tables beside the builds; empty if nothing was written to it yet."""
    fs, make = _files(spark, path)
    if not fs.exists(make(f"{path}/{name}")):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/{name}")


def _append(spark: SparkSession, path: str, name: str, schema: str, rows: list[tuple]) -> None:
    if rows:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{path}/{name}")


def _names(df: DataFrame) -> set[str]:
    return {r["build"] for r in df.select("build").distinct().collect()}  # builds, of which a mart has some dozens


class NoBuild(LookupError):
    """The mart has no complete build that is not retired."""


def open_mart(spark: SparkSession, path: str, lease: dt.timedelta = dt.timedelta(hours=12), now: dt.datetime | None = None,
              reader: str | None = None) -> tuple[DataFrame, str]:
    """The newest build's rows and the lease (its reader's name), which keeps
    the build until ``close_mart`` or its end. Readers that take longer renew it by opening again under the same name."""
    now, reader = now or _now(), reader or uuid.uuid4().hex[:12]
    while True:
        gone = _names(table(spark, path, "retired", RETIRED))
        builds = [r["build"] for r in table(spark, path, "builds", BUILDS).orderBy(F.col("built_at").desc(), "build").collect()]
        build = next((b for b in builds if b not in gone), None)
        if build is None:
            raise NoBuild(path)
        _append(spark, path, "leases", LEASES, [(build, reader, now + lease, now)])
        if build not in _names(table(spark, path, "retired", RETIRED)):
            return read_fact(spark, os.path.join(path, build)), reader


def close_mart(spark: SparkSession, path: str, reader: str, now: dt.datetime | None = None) -> None:
    """End a reader's leases."""
    held, end = table(spark, path, "leases", LEASES).where(F.col("reader") == reader), now or _now()
    _append(spark, path, "leases", LEASES, [(b, reader, end, end) for b in sorted(_names(held))])


def leased(spark: SparkSession, path: str, now: dt.datetime) -> set[str]:
    """Builds with a lease that has not ended: of a reader's leases of a build the newest counts, and of equally new ones the first to end."""
    newest = F.max_by("until", F.struct("at", -F.unix_micros("until")))
    rows = table(spark, path, "leases", LEASES).groupBy("build", "reader").agg(newest.alias("until"))
    return _names(rows.where(F.col("until") > F.lit(now)))


def expire_builds(spark: SparkSession, path: str, keep: int = 1, grace: dt.timedelta = dt.timedelta(days=2), now: dt.datetime | None = None) -> dict[str, list[str]]:
    """Retire the builds beyond the newest ``keep`` that were superseded at
    least ``grace`` ago, and failed ones as old; delete the folders of retired builds without a
    lease. Returns what was retired and deleted now, and what still is leased."""
    now = now or _now()
    builds = [(r["build"], r["built_at"]) for r in table(spark, path, "builds", BUILDS)
              .select("build", F.col("built_at").cast("timestamp")).orderBy(F.col("built_at").desc(), F.col("build")).collect()]
    gone, deleted = _names(table(spark, path, "retired", RETIRED)), _names(table(spark, path, "deleted", DELETED))
    limit = (now - grace).timestamp()
    # a build is superseded when the next one is built
    old = [b for k, (b, _) in enumerate(builds) if k >= keep and builds[k - 1][1].timestamp() <= limit]
    fs, make = _files(spark, path)
    known = {b for b, _ in builds}
    failed = [s.getPath().getName() for s in fs.listStatus(make(path)) if s.getPath().getName().startswith("build-")
              and s.getPath().getName() not in known and s.getModificationTime() / 1000 <= limit]
    new = sorted(b for b in {*old, *failed} if b not in gone)
    _append(spark, path, "retired", RETIRED, [(b, now) for b in new])
    held = leased(spark, path, now)
    free = sorted(b for b in {*gone, *new} if b not in deleted and b not in held)
    for b in free:
        fs.delete(make(f"{path}/{b}"), True)
    _append(spark, path, "deleted", DELETED, [(b, now) for b in free])
    return {"retired": new, "deleted": free, "leased": sorted(b for b in {*gone, *new} if b in held)}
