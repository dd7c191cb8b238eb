"""An old-layout object tree in the shared folder, made from the order table,
for the back-fill query: per order year one FX file (silver) and one document
(bronze). An object of the old layout is a single file, so each is one
task's; the years are a list as long as the calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.plans.demo import silver_currency, table
from lodestone.session import materialize

DAMAGED_YEAR = 1995  # of the FX files
HOUR = "08-00-00"    # file systems below Spark take no colon in a name
YEAR_TASKS = 64      # so many that few years share one


def damage(spark: SparkSession, path: str) -> None:
    """Overwrite 512 bytes in the middle of a file, as a broken disk or
    transfer would; its footer stays readable. Streams through the file
    system's own API, so it works wherever Spark writes."""
    jvm, conf = spark._jvm, spark._jsparkSession.sparkContext().hadoopConfiguration()
    old, new = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, path + ".tmp"))
    fs = old.getFileSystem(conf)
    source, sink = fs.open(old), fs.create(new)
    at, bad = 0, range(fs.getFileStatus(old).getLen() // 2, fs.getFileStatus(old).getLen() // 2 + 512)
    while len(chunk := bytearray(source.readNBytes(1 << 20))):
        for k in range(max(bad.start, at), min(bad.stop, at + len(chunk))):
            chunk[k - at] = 0xFF
        sink.write(chunk)
        at += len(chunk)
    source.close()
    sink.close()
    fs.delete(old, False)
    fs.rename(new, old)


def one_file(spark: SparkSession, folder: str) -> str:
    """Path of the only data file of a written folder."""
    return spark.read.format("binaryFile").load(folder).select("path").first()[0]


def write_old_tree(spark: SparkSession, sf_dir: str, root: str) -> list[int]:
    """Write the tree below ``root``, damage one file, and return the years."""
    y = F.year("o_orderdate").alias("y")
    per_year = materialize(table(spark, sf_dir, "orders").groupBy(y).agg(F.count("*").alias("n_orders"), F.max("o_totalprice").alias("highest")))
    size = {r["y"]: r["n_orders"] for r in per_year.select("y", "n_orders").collect()}  # as many as the calendar has years
    years = sorted(size)
    # all years in one pass over the orders, each by one task: an object is one file
    rates: DataFrame = silver_currency(spark, sf_dir).drop("ingested_at").withColumn("y", F.substring("rate_date", 1, 4).cast("int"))
    # row groups small against a file, so that it has readable ones before its
    # damage, and not more of them in larger files, whose footers every reader parses
    rates.repartition(YEAR_TASKS, "y").write.option("parquet.block.size", max(8192, 2 * max(size.values(), default=0))).partitionBy("y").parquet(f"{root}-by-year")
    jvm, conf = spark._jvm, spark._jsparkSession.sparkContext().hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path
    fs = place(root).getFileSystem(conf)
    for y in years:
        fs.mkdirs(place(f"{root}/silver/{y}-01-01 {HOUR}"))
        if not fs.rename(place(f"{root}-by-year/y={y}"), place(f"{root}/silver/{y}-01-01 {HOUR}/currency_rates")):
            raise OSError(f"no FX file of {y}")
        doc = per_year.where(F.col("y") == y).select(F.to_json(F.struct("n_orders", "highest")).alias("value")).coalesce(1)
        doc.write.text(f"{root}/bronze/{y}-01-01 {HOUR}/metal_prices")
    damage(spark, one_file(spark, f"{root}/silver/{DAMAGED_YEAR}-01-01 {HOUR}/currency_rates"))
    return years
