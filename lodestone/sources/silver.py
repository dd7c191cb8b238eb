"""Silver Parquet tables partitioned by ``ingested_at`` (SRC-3..10, FLT-7/9).

Writes use dynamic partition overwrite: a re-run of a day replaces exactly
that day's partition, other days are untouched, and an empty frame writes
nothing (the previous data stays). Reads always pass the explicit schema,
so the partition column stays a string and nothing is inferred.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone import config, schemas


def write_silver(valid: DataFrame, path: str, feed: str, balance: bool = True) -> None:
    """SRC-3. With ``balance`` the rows are rebalanced on the day before the
    write: AQE coalesces small days into few tasks (a daily load is one file)
    and splits a day that holds a large share of the rows over several tasks,
    so no single task writes a hot day."""
    cols = schemas.column_names(schemas.SILVER[feed])
    loaded = F.col("loaded_at") if "loaded_at" in valid.columns else F.current_timestamp()
    out = valid.select(*cols, loaded.alias("loaded_at"), schemas.PARTITION_COLUMN)
    if balance:
        out = out.hint("rebalance", schemas.PARTITION_COLUMN)
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(schemas.PARTITION_COLUMN).parquet(path))


def read_silver(spark: SparkSession, path: str, feed: str) -> DataFrame:
    """SRC-4..7: external Parquet scan with the fixed schema (files written
    without ``loaded_at`` read it as null)."""
    return spark.read.schema(schemas.silver_with_partition(feed)).parquet(path)


def calendar(start: str, end: str) -> list[str]:
    """All days from ``start`` to ``end``, both included, as partition values."""
    first, last = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    return [(first + dt.timedelta(days=k)).isoformat() for k in range((last - first).days + 1)]


def day_folder(path: str, day: str) -> str:
    return f"{path.rstrip('/')}/{schemas.PARTITION_COLUMN}={day}"


def present_days(spark: SparkSession, path: str, days: list[str], threads: int = 32) -> list[str]:
    """The days whose folder exists. Each is asked for by name through the
    file system of the path, many at a time; the folder above is never listed,
    so neither the number of other folders nor their names matter."""
    jvm, conf = spark._jvm, spark._jsparkSession.sparkContext().hadoopConfiguration()
    files = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(conf)

    def there(day: str) -> bool:
        return files.exists(jvm.org.apache.hadoop.fs.Path(day_folder(path, day)))
    with ThreadPoolExecutor(threads) as pool:
        return [d for d, ok in zip(days, pool.map(there, days), strict=True) if ok]


def read_days(spark: SparkSession, path: str, feed: str, start: str, end: str) -> DataFrame:
    """SRC-8: the partitions of the days from ``start`` to ``end``, computed
    from the calendar and not found by listing. Absent days have no rows; what
    else lies in the table's folder is not seen."""
    days = present_days(spark, path, calendar(start, end))
    schema = schemas.silver_with_partition(feed)
    if not days:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*[day_folder(path, d) for d in days])


def partition_window(df: DataFrame, run_date: str, start: str = config.PROJECTION_START) -> DataFrame:
    """SRC-8 on a frame: only partitions from ``start`` to ``run_date`` are visible. On a
    partitioned scan this is a PartitionFilter (directories are pruned)."""
    return df.where(F.col(schemas.PARTITION_COLUMN).between(start, run_date))


def add_days(spark: SparkSession, table: str, path: str, days: list[str], batch: int = 1000) -> None:
    """Make some days of a table known to the catalog, ``batch`` at a time;
    days it knows already stay."""
    for at in range(0, len(days), batch):
        parts = " ".join(f"PARTITION ({schemas.PARTITION_COLUMN} = '{d}') LOCATION '{day_folder(path, d)}'" for d in days[at:at + batch])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {parts}")


def register_table(spark: SparkSession, database: str, name: str, path: str, feed: str,
                   start: str = config.PROJECTION_START, end: str | None = None) -> None:
    """SRC-9/10/18: catalog database + external table over the silver folder,
    with the days from ``start`` to ``end`` (today, UTC) that are there. Days
    that land later are added by ``add_days``."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    ddl = schemas.SILVER[feed] + f", {schemas.LOAD_INSTANT}, {schemas.PARTITION_COLUMN} string"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({ddl}) USING parquet "
              f"PARTITIONED BY ({schemas.PARTITION_COLUMN}) LOCATION '{path}'")
    end = end or dt.datetime.now(dt.UTC).date().isoformat()
    add_days(spark, f"{database}.{name}", path, present_days(spark, path, calendar(start, end)))


def count_rows(df: DataFrame, name: str = "silver") -> tuple[DataFrame, object]:
    """FLT-7: accepted-row counter as an observed metric (no extra job)."""
    from pyspark.sql import Observation

    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs
